"""Parameters that queries and pipeline share."""

N_SHARDS = 8
TOKEN_LIMIT = 4096
# Target shares of the sources, in hundredths; the rest go to all others together.
SOURCE_WEIGHTS = (
    {"src0": 20, "src1": 10, "src2": 10, "src3": 8, "src4": 8}
    | {f"src{i}": 4 for i in range(5, 10)}
    | {f"src{i}": 2 for i in range(10, 20)}
)
OTHER_WEIGHT = 4
