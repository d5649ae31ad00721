"""Key construction and stable hashing (K1, K2, K3, K5).

Keys are plain string concatenations; a null component or a missing column
becomes ``""``. ``concat_ws`` is not used because it skips nulls.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import ENTITY_KEY_COLUMNS, FINGERPRINT_KEY_COLUMNS, KEY_SEPARATOR


def _part(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.lit("")


def composite_key(df: DataFrame, cols: Iterable[str], sep: str = KEY_SEPARATOR) -> Column:
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_part(df, c))
    return F.concat(*parts)


def entity_key(df: DataFrame, cols: Iterable[str] = ENTITY_KEY_COLUMNS) -> Column:
    """K1: ``card1||card2||card3||card5||addr1``."""
    return composite_key(df, cols)


def fingerprint_key(df: DataFrame, cols: Iterable[str] = FINGERPRINT_KEY_COLUMNS) -> Column:
    """K2: ``DeviceInfo||P_emaildomain||ProductCD``."""
    return composite_key(df, cols)


def na_token(c) -> Column:
    """K5: categorical value as string, null shown as ``<NA>``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("<NA>"))


def stable_hash_bucket(c, buckets: int) -> Column:
    """K3: ``int(md5(value).hexdigest(), 16) % buckets``; null -> ``""``.

    Power-of-two buckets up to 2^20 only need the last five hex digits. Other
    sizes use Horner's rule over four 32-bit chunks of the 128-bit digest, which
    keeps every intermediate below 2^63.
    """
    c = F.col(c) if isinstance(c, str) else c
    h = F.md5(F.coalesce(c.cast("string"), F.lit("")))
    if buckets & (buckets - 1) == 0 and buckets <= 2 ** 20:
        return (F.conv(F.substring(h, 28, 5), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
    if buckets >= 2 ** 31:
        raise ValueError("buckets must be < 2^31")
    r = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")
        r = (r * F.lit(2 ** 32) + chunk) % F.lit(buckets)
    return r.cast("int")


_WORD = 0xFFFFFFFF


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` computed once, however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]


def _times(x: Column, c: int) -> Column:
    """Low 32 bits of ``x * c`` for 0 <= x < 2^32: with ``c`` as a signed number the product stays inside 63 bits."""
    return (x * F.lit(c - (1 << 32) if c >> 31 else c).cast("bigint")).bitwiseAND(F.lit(_WORD))


def _rotated(x: Column, by: int) -> Column:
    return _let(x, lambda v: F.shiftleft(v, by).bitwiseAND(F.lit(_WORD)).bitwiseOR(F.shiftright(v, 32 - by)))


def _shifted(x: Column, *by: int) -> Column:
    def f(v: Column) -> Column:
        out = v
        for n in by:
            out = out.bitwiseXOR(F.shiftright(v, n))
        return out
    return _let(x, f)


def _undone(c: int) -> int:
    return pow(c, -1, 1 << 32)


def _spark_seed(seed: int) -> int:
    """The integer whose ``F.hash`` is ``seed`` (signed): columns hashed after it start from there."""
    h = seed & _WORD
    h ^= h >> 16
    h = h * _undone(0xC2B2AE35) & _WORD
    h ^= h >> 13 ^ h >> 26
    h = h * _undone(0x85EBCA6B) & _WORD
    h ^= h >> 16 ^ 4                                              # four bytes
    h = (h - 0xE6546B64) * _undone(5) & _WORD
    k = (h >> 13 | h << 19) & _WORD ^ 42
    k = k * _undone(0x1B873593) & _WORD
    k = (k >> 15 | k << 17) & _WORD
    k = k * _undone(0xCC9E2D51) & _WORD
    return k - (1 << 32) if k >> 31 else k


def murmur3_32(c, seed: int = 0) -> Column:
    """Signed 32-bit Murmur3 (x86) of a string's UTF-8 bytes, as a long, in column expressions; null for null. Spark's own
    ``hash`` has another seed and treats the last bytes in its own way: it hashes the whole words, its last steps are
    taken back, and the last bytes and the length follow as in the public algorithm."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")

    def run(b: Column) -> Column:
        size = F.length(b)
        whole = size - size % 4
        h = F.hash(F.lit(_spark_seed(seed)), F.substring(b, F.lit(1), whole)).cast("bigint").bitwiseAND(F.lit(_WORD))
        h = _shifted(_times(_shifted(_times(_shifted(h, 16), _undone(0xC2B2AE35)), 13, 26), _undone(0x85EBCA6B)), 16).bitwiseXOR(whole.cast("bigint"))
        rest = _let(F.hex(F.substring(b, whole + 1, F.lit(3))), lambda t: F.conv(F.concat(F.lit("0"), *[F.substring(t, at, 2) for at in (5, 3, 1)]), 16, 10).cast("bigint"))
        h = h.bitwiseXOR(_times(_rotated(_times(rest, 0xCC9E2D51), 15), 0x1B873593)).bitwiseXOR(size.cast("bigint"))
        h = _shifted(_times(_shifted(_times(_shifted(h, 16), 0x85EBCA6B), 13), 0xC2B2AE35), 16)
        return _let(h, lambda v: F.when(v >= F.lit(1 << 31), v - F.lit(1 << 32)).otherwise(v))

    return _let(F.encode(c, "UTF-8"), lambda b: F.when(b.isNotNull(), run(b)))


def signed_hashes(cols: Sequence[str], buckets: int, names: Sequence[str] | None = None) -> Column:
    """K4: array of (``index``, ``sign``), one for each of ``cols``: the hash of ``name=value`` modulo ``buckets`` by its
    size, and its sign. ``names`` stand for the columns' own; a null value is left out."""
    out = []
    for c, name in zip(cols, names or cols, strict=True):
        h = murmur3_32(F.concat(F.lit(f"{name}="), F.col(c).cast("string")))
        out.append(_let(h, lambda v: F.when(v.isNotNull(), F.struct((F.abs(v) % F.lit(buckets)).cast("int").alias("index"), F.when(v >= 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign")))))
    return F.array_compact(F.array(*out))


def summed_hashes(hashes: Column) -> Column:
    """The entries of a :func:`signed_hashes` array by index, ascending, those of one index added up (to zero where they cancel)."""
    def summed(hs: Column) -> Column:
        return F.transform(F.array_sort(F.array_distinct(F.transform(hs, lambda e: e["index"]))), lambda i: F.struct(
            i.alias("index"), F.aggregate(hs, F.lit(0.0), lambda acc, e: acc + F.when(e["index"] == i, e["sign"]).otherwise(F.lit(0.0))).alias("value")))

    return _let(hashes, summed)         # inside a lambda the hashes would be computed again for each index
