"""One query per operator of this subpackage, over the whole of its table, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, table
from slumptrace.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document. Null and empty texts have none; rows with equal or null ids are rows of their own; an empty
    table gives no rows.
    """
    from slumptrace.llm.secrets import scan, train

    documents = table(spark, folder, "documents")
    return scan(documents, train(documents))


def op2_brown(spark: SparkSession, folder: str) -> DataFrame:
    """Class-model scores of every document. A null or empty text is its end token alone; rows with equal ids are scored each; an
    empty table gives no rows.
    """
    from slumptrace.llm.brown import score_texts

    return score_texts(table(spark, folder, "documents"))


def op3_reshard(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document. Null texts have size 16; null ids and repeated rows are rows like others; an empty table
    gives no rows.
    """
    from slumptrace.llm.reshard import reshard, with_sizes

    rows = reshard(with_sizes(table(spark, folder, "documents")))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items. Null and empty texts hold none; repeated rows and ids are reported once; empty tables
    give no rows.
    """
    from slumptrace.llm.decontam import overlaps

    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_url_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page. Null, empty and malformed URLs have no rule and no alias and are allowed; repeated rows are judged
    alike; an empty table gives no rows.
    """
    from slumptrace.llm.aliases import judge, page_edges

    pages = table(spark, folder, "pages")
    staging = Staging(spark, "aliases")
    edges = staging.keep(page_edges(pages), "edges")
    return judge(pages, edges, staging).select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Near-copy component of every document. Null and empty texts have no shingles and link with nothing; rows without an id
    have no component of their own; an empty table gives no rows.
    """
    from slumptrace.llm.jaccard import near_copies

    return near_copies(table(spark, folder, "documents")).drop("text_key")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document. A null or empty text is one sentence without words; documents without a label are
    scored as well; an empty table gives no rows.
    """
    from slumptrace.llm.toxicity import THRESHOLD, is_held_out, score, train

    documents = table(spark, folder, "documents")
    model = train(documents, table(spark, folder, "labels"))
    return score(documents, model).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_sentences", "worst_sentence", "worst_score", "worst_text")


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in documents. Null, empty and one-word texts match nothing; rows with the same id are reported together;
    an empty table gives no rows.
    """
    from slumptrace.llm.licenses import licence_matches

    return licence_matches(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document in sequences. A null or empty text is the end id alone; rows with equal or null ids are packed
    each; an empty table gives no rows.
    """
    from slumptrace.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"))


def op10_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors. Null, empty and zero vectors and those with null or non-finite entries link with
    nothing; vectors link with others of their length; an empty table gives no rows.
    """
    from slumptrace.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


def op11_sentencepieces(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and what they decode to. A null or empty text is begin and end alone; rows with equal or
    null ids are encoded each; an empty table gives no rows.
    """
    from slumptrace.llm.sentencepieces import encode_documents

    return encode_documents(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every usable vector. Null and empty vectors and those with null or non-finite entries give no
    rows; repeated rows are fitted once and returned each; an empty table gives no rows.
    """
    from slumptrace.llm.whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every item. Null and empty texts are found by nothing; equal scores rank by id, rows without an
    id last; items with one id are one item; empty tables give no rows.
    """
    from slumptrace.llm.search import search

    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f for f in (
        op1_secrets, op2_brown, op3_reshard, op4_decontaminate, op5_url_aliases, op6_jaccard, op7_toxicity, op8_licences,
        op9_packing, op10_vectors, op11_sentencepieces, op12_whitening, op13_search)
}
