"""Layout-independent row sampling.

``DataFrame.sample(seed=...)`` draws per partition, so the same seed keeps
different rows after a repartition. Hashing a key instead keeps a row exactly
when the first 20 bits of ``md5("seed|key|...")`` are below ``fraction *
2**20``, whatever the partitioning, without a shuffle, and any SQL engine can
repeat it. Null keys count as empty text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1 << 20


def hash_sample_predicate(keys: Sequence[str], fraction: float, seed: int = 42) -> Column:
    if not keys:
        raise ValueError("hash sampling needs at least one key column")
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(int(seed))), *parts).cast("binary"))
    limit = min(int(round(fraction * BUCKETS)), BUCKETS - 1)
    # five lower-case hexadecimal digits compare as text like the number they are
    return F.substring(digest, 1, 5) < F.lit(f"{limit:05x}")
