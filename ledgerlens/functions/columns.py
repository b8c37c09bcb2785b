"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Script types in the order of their tags.
SCRIPT_TYPES = ["P2PKH", "P2SH", "P2WPKH", "P2WSH", "P2TR", "P2PK", "NULL_DATA", "UNKNOWN"]


def difficulty(bits: Column) -> Column:
    """From the 8 hex digits of a header's bits: 0xffff / mantissa * 2^(8 (0x1d - exponent))."""
    exponent = F.conv(F.substring(bits, 1, 2), 16, 10).cast("int")
    mantissa = F.conv(F.substring(bits, 3, 6), 16, 10).cast("double")
    return F.lit(65535.0) / mantissa * F.pow(F.lit(2.0), (F.lit(29) - exponent) * 8)


def script_tag(script_type: Column) -> Column:
    tags = F.create_map(*[x for k, name in enumerate(SCRIPT_TYPES) for x in (F.lit(name), F.lit(k))])
    return F.coalesce(F.try_element_at(tags, script_type), F.lit(SCRIPT_TYPES.index("UNKNOWN")))


def script_type(script: Column) -> Column:
    """Class of a script given as hex, from its shape alone; pay-to-pubkey goes by the length of the key."""
    s, n = F.lower(script), F.length(script)
    key = (n == 70) & s.rlike("^21(02|03)[0-9a-f]{64}ac$") | (n == 134) & s.rlike("^4104[0-9a-f]{128}ac$")
    return (
        F.when(s.startswith("6a"), "NULL_DATA")
        .when(s.rlike("^76a914[0-9a-f]{40}88ac$"), "P2PKH")
        .when(s.rlike("^a914[0-9a-f]{40}87$"), "P2SH")
        .when(s.rlike("^0014[0-9a-f]{40}$"), "P2WPKH")
        .when(s.rlike("^0020[0-9a-f]{64}$"), "P2WSH")
        .when(s.rlike("^51(02|03|04|05|06|07|08|09|0a|0b|0c|0d|0e|0f|1[0-9a-f]|2[0-8])") & (n == 4 + 2 * F.conv(F.substring(s, 3, 2), 16, 10).cast("int")), "P2TR")
        .when(key, "P2PK")
        .otherwise("UNKNOWN")
    )


def locktime_kind(locktime: Column) -> Column:
    return F.when(locktime == 0, "none").when(locktime < 500_000_000, "height").otherwise("time")


def signals_rbf(sequence: Column) -> Column:
    return sequence < 4294967294


def format_eta(seconds: Column) -> Column:
    """XhYm, Ym below an hour, n/a where null, 0 or below."""
    whole = F.floor(seconds).cast("long")
    hours, minutes = F.floor(whole / 3600).cast("string"), F.floor(whole % 3600 / 60).cast("string")
    return F.when(seconds.isNull() | (seconds <= 0), "n/a").when(whole >= 3600, F.concat(hours, F.lit("h"), minutes, F.lit("m"))).otherwise(F.concat(minutes, F.lit("m")))


def output_key(txid: Column, index: Column) -> Column:
    """txid:index; null where the txid isn't 64 hex digits."""
    return F.when(txid.rlike("^[0-9a-fA-F]{64}$"), F.concat_ws(":", F.lower(txid), index.cast("string")))


def output_key_parts(key: Column) -> Column:
    """txid and index of a key of output_key, as a struct; null where it is none."""
    good = key.rlike("^[0-9a-f]{64}:[0-9]{1,10}$")
    return F.when(good, F.struct(F.substring(key, 1, 64).alias("txid"), F.substring(key, 66, 10).cast("long").alias("output_index")))


#: The bytes of a txid, in its internal order (the reverse of that shown), that choose an output's shard; shards.
SHARD_BYTES, SHARDS = (0, 7, 15, 23, 31), 16


def shard(txid: Column, index: Column) -> Column:
    """0 to 15, from the txid as shown and the output's index: some of the bytes and the index exclusive-ored."""
    out = index.cast("long")
    for k in SHARD_BYTES:
        out = out.bitwiseXOR(F.conv(F.substring(txid, 2 * (31 - k) + 1, 2), 16, 10).cast("long"))
    return out.bitwiseAND(F.lit(SHARDS - 1).cast("long"))


def display_hash(raw: Column) -> Column:
    """A binary hash in its internal order, as the reversed hex that is shown."""
    return F.array_join(F.reverse(F.regexp_extract_all(F.lower(F.hex(raw)), F.lit("(..)"))), "")
