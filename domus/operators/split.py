"""K1 exact_split, K2 group_split, K9 kfold_assign, F3 half_split.

Row order does not exist in a DataFrame, so every split is defined over a unique key:
rows are ordered by ``md5(seed | key)`` (a seeded shuffle that does not depend on
partitioning), and cut at exact sizes with ``segment_by_rank``. Only the hash buckets
that hold a cut are ever sorted, and the labels are a projection.

Splits need a unique key. ``require_unique`` finds out once a table; a caller that has asked
passes ``check_unique=False`` to every split of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import TrainingError
from domus.operators.rank import hash_bucket, hash_order, require_unique, segment_by_rank
from domus.session import materialize

_H = "_split_hash"


def split_sizes(n: int, test_size: float, calibration_size: float) -> tuple[int, int, int]:
    """(n_train, n_cal, n_test) with half-even rounding; any empty part -> error."""
    n_test = round(n * test_size)
    n_cal = round(n * calibration_size)
    n_train = n - n_test - n_cal
    if min(n_train, n_cal, n_test) <= 0:
        raise TrainingError(f"{n} rows leave a part of the split empty")
    return n_train, n_cal, n_test


# 16^4 hash buckets: a bucket table of <= 65,536 rows, and ~15M rows per bucket at 10^12 rows
_DIGITS = 4


def default_key(df: DataFrame) -> str | tuple[str, ...]:
    """``uid`` where there is one, else the key of the listing panel."""
    return "uid" if "uid" in df.columns else ("id", "snapshot_month")


def key_columns(key: str | tuple[str, ...]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hash_segments(df: DataFrame, key: str | tuple[str, ...], seed: int, cuts, col: str,
                  check_unique: bool = True) -> DataFrame:
    """Segments of the seeded hash order; the row count comes from the job that counts the hash buckets."""
    keys = key_columns(key)
    asked = df.select(*keys)
    if check_unique:
        asked = materialize(asked)  # the check and the cuts read the keys four times, and the frame may be a join
        require_unique(asked, keys)
    h = hash_order(seed, *keys)
    out = segment_by_rank(df.withColumn(_H, h), [_H, *keys], cuts, col, bucket=hash_bucket(_H, _DIGITS),
                          keys=asked.withColumn(_H, h))
    return out.drop(_H)


def exact_split(df: DataFrame, key: str | tuple[str, ...] = "uid", test_size: float = C.TEST_SIZE,
                calibration_size: float = C.CALIBRATION_SIZE, seed: int = C.SEED,
                part_col: str = "part", check_unique: bool = True) -> DataFrame:
    """K1: label each row 'test' / 'cal' / 'train' with exact sizes.

    In seeded hash order the first ``round(n*test)`` rows are test, the next
    ``round(n*cal)`` calibration, the rest train.
    """
    def cuts(n: int) -> list[int]:
        _, n_cal, n_test = split_sizes(n, test_size, calibration_size)
        return [n_test, n_test + n_cal]

    seg = _checked(lambda: hash_segments(df, key, seed, cuts, "_seg", check_unique))
    label = F.when(F.col("_seg") == 0, "test").when(F.col("_seg") == 1, "cal").otherwise("train")
    return seg.withColumn(part_col, label).drop("_seg")


def group_split(df: DataFrame, group_key: str = "id", test_size: float = C.TEST_SIZE,
                calibration_size: float = C.CALIBRATION_SIZE, seed: int = C.SEED,
                part_col: str = "part") -> DataFrame:
    """K2: all rows of one ``group_key`` land in the same part; sizes are approximate.

    u = first 8 hex digits of md5(seed | key) / 16^8, uniform in [0, 1): test when
    u < test_size, calibration when u < test_size + calibration_size. A narrow projection.
    """
    u = F.conv(F.substring(hash_order(seed, group_key), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    label = (F.when(u < test_size, "test").when(u < test_size + calibration_size, "cal")
             .otherwise("train"))
    return df.withColumn(part_col, label)


def kfold_sizes(n: int, k: int) -> list[int]:
    """Shuffled k-fold sizes: k = min(k, n); the first n % k folds get one extra row."""
    k = min(k, n)
    if k < 2:
        raise TrainingError(f"folds need two rows or more; there are {n}")
    return [n // k + (1 if i < n % k else 0) for i in range(k)]


def kfold_assign(df: DataFrame, key: str | tuple[str, ...] = "uid", k: int = 5, seed: int = C.SEED,
                 fold_col: str = "fold", check_unique: bool = True) -> DataFrame:
    """K9: fold 0..k-1, contiguous runs of the seeded hash order with k-fold sizes."""
    def cuts(n: int) -> list[int]:
        out, acc = [], 0
        for s in kfold_sizes(n, k)[:-1]:
            acc += s
            out.append(acc)
        return out

    return _checked(lambda: hash_segments(df, key, seed, cuts, fold_col, check_unique))


def _checked(fn):
    try:
        return fn()
    except ValueError as exc:  # non-unique key reported by the bucket job
        raise TrainingError(str(exc)) from exc


def half_split(df: DataFrame, order_cols: list[str], side_col: str = "side",
               n: int | None = None, check_unique: bool = True) -> DataFrame:
    """First ``n // 2`` rows in ``order_cols`` order are 'reference', the rest 'current'.

    The order columns must form a unique key; buckets are cut on the
    whole key, so a repeated leading value does not make one hot bucket.
    """
    if check_unique:
        _checked(lambda: require_unique(df, order_cols))
    # the row count comes from the same job that counts the range buckets
    seg = segment_by_rank(df, order_cols, lambda total: [total // 2], "_seg", n=n)
    return (seg.withColumn(side_col, F.when(F.col("_seg") == 0, "reference").otherwise("current"))
            .drop("_seg"))
