"""Sharding by jump consistent hashing: a stable key and the shard count decide; no ring table.

The key's 64 bits come from the MD5 of its decimal form.  The jump sequence of a key doesn't
depend on the shard count: its shard is the last jump below it.  So with one shard more a row
either stays or moves into the new shard, and only the share 1 / (n + 1) moves.

Plain column expressions.  The 64-bit generator step is done on two 32-bit halves in long
arithmetic, because a wrapping product isn't available under ANSI rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import gapless_rank

SHARDS = 24
#: Multiplier of the linear congruential step, and the two scales of a jump.
STEP = 2862933555777941757
HALF, TOP = 1 << 32, 1 << 31


def key_halves(key: Column) -> tuple[Column, Column]:
    """The upper and lower 32 bits of a key's stable hash, as longs; a NULL key hashes as ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return part(1), part(9)


def _low(a: Column, b: int) -> Column:
    """a * b mod 2**32 for a below 2**32, without a product over 2**49."""
    return F.pmod(a * F.lit(b & 0xFFFF) + F.shiftleft(F.pmod(a * F.lit(b >> 16), F.lit(1 << 16)), 16), F.lit(HALF))


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * STEP + 1 mod 2**64 in halves."""
    up, down = STEP >> 32, STEP & 0xFFFFFFFF
    p0, p1 = lo * F.lit(down & 0xFFFF), lo * F.lit(down >> 16)
    low = p0 + F.shiftleft(F.pmod(p1, F.lit(1 << 16)), 16) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(p1, 16)
    return F.pmod(_low(hi, down) + _low(lo, up) + carry, F.lit(HALF)), F.pmod(low, F.lit(HALF))


def jump(key: Column, shards: int) -> tuple[Column, Column]:
    """A key's shard among ``shards`` and among one more.

    The state is (upper half, lower half, shard b, next jump j).  A step is taken while j is
    below ``shards``; every step raises j, so ``shards`` steps are enough and a key takes about
    ln(shards) of them.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    hi, lo = key_halves(key)
    state = lambda h, x, b, j: F.struct(h.alias("h"), x.alias("l"), b.alias("b"), j.alias("j"))
    zero = F.lit(0).cast("long")

    def step(s: Column, _: Column) -> Column:
        h, x = _next(s["h"], s["l"])
        # (b + 1) * 2**31 / ((key >> 33) + 1) in doubles, floored
        leap = F.floor((s["j"] + 1).cast("double") * (F.lit(float(TOP)) / (F.shiftright(h, 1) + 1).cast("double")))
        return F.when(s["j"] >= shards, s).otherwise(state(h, x, s["j"], leap.cast("long")))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), state(hi, lo, zero, zero), step)
    # with one shard more, a key whose next jump lands exactly on it goes there
    both = F.transform(F.array(done), lambda s: F.struct(
        s["b"].cast("int").alias("now"), F.when(s["j"] == shards, F.lit(shards)).otherwise(s["b"]).cast("int").alias("then")))
    return both[0]["now"], both[0]["then"]


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", cells: int = 256) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard.

    * ``size``: UTF-8 bytes of the text (NULL: none) plus 8; ``text_crc32``: of the same bytes.
    * ``shard`` and ``grown_shard``: among ``shards`` and one more.  A NULL key has a shard of its own hash.
    * ``slot``: 0, 1, 2 ... in the shard, by hash cell of the row, so no shard is sorted in one
      task.  Rows equal in all returned columns are interchangeable.
    * Only the key and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    now, then = jump(F.col(key), shards)
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(raw.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                       F.explode(F.array(F.struct(now.alias("now"), then.alias("then")))).alias("jumped"))
    rows = rows.select("doc_id", "size", "text_crc32", "law", F.col("jumped.now").alias("shard"),
                       F.col("jumped.then").alias("grown_shard"))
    return gapless_rank(rows, ["shard"], ["doc_id", "size", "text_crc32"], "slot", cells).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
