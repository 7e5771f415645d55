"""Fixed on-chain values and the default settings of the two analysis stages."""

# Event signatures and contract addresses as they stand on the Ethereum chain.
PAIR_FACTORY = "0x5c69bee701ef814a2b6a3edd4b1652cb9cc5aa6f"
PAIR_CREATED_TOPIC = "0x0d3648bd0f6ba80134a33ba9275ac585d9d315f0ad8355cddefde31afa28d0e9"
SWAP_TOPIC = "0xd78ad95fa46c994b6551d0da85fc275fe613ce37657fb8d5e3d130840159d822"
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"

# The tokens a crisis token may be paired with.
BASE_TOKENS = {
    "0x6b175474e89094c44da98b954eedeac495271d0f": "DAI",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "USDC",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "USDT",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "WETH",
}

# Names that appear in the tables.
PAIR_PROTOCOL = "Uniswap V2"
UNKNOWN_PROTOCOL = "Unknown"
UNKNOWN_SYMBOL = "UNK"
CHAIN = "ethereum"
ADDRESS_LENGTH = 42

# Default settings.
TOKEN_DECIMALS = 18
DEFAULT_PRICE = 1.0
RECOVERY_DAYS = 90
MIN_PROFIT_PCT = 10.0
TOP_WALLETS = 10
MAX_CRISIS_MOVE_PCT = -5.0
MOVE_OFFSET_DAYS = 7
