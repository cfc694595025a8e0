"""Parameters shared by the registered queries and their SQL."""

MIN_CHARS = 300  # low enough that every later reject reason is reached
BUDGET = 400_000  # cuts the smaller test sets
WHOLE = 10**12  # cuts nothing
VAL_RATIO = 0.1
LIMIT = 100
VOCAB = 300
MERGES = VOCAB - 260
BLOCK = 64
WINDOWS = 500
DRAWS = {"loss": 400, "accuracy": 100}
SHARD = 10_000  # tokens
STRIDE = 104_729  # spreads the given window starts over the stream
SEED = 7
ADD_K = 1.0
TEMPERATURE = 0.8
TOP_K = 5
