"""Addresses of output scripts: Base58Check, Bech32 and Bech32m, over the distinct scripts of a table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Version bytes and human-readable part by network.
NETWORKS = {"mainnet": (0x00, 0x05, "bc"), "testnet": (0x6F, 0xC4, "tb"), "regtest": (0x6F, 0xC4, "bcrt")}
#: The alphabets and checksum constants of the encodings, and the curve's prime.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = [0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]
BECH32_FINAL = {0: 1, 1: 0x2BC830A3}
PRIME = 2**256 - 2**32 - 977


def double_sha256(data: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(data).digest()).digest()


def hash160(data: bytes) -> bytes:
    return hashlib.new("ripemd160", hashlib.sha256(data).digest()).digest()


def base58check(version: int, payload: bytes) -> str:
    data = bytes([version]) + payload
    data += double_sha256(data)[:4]
    n, digits = int.from_bytes(data), []
    while n:
        n, r = divmod(n, 58)
        digits.append(BASE58[r])
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + "".join(reversed(digits))


def _polymod(values: list[int]) -> int:
    c = 1
    for v in values:
        top, c = c >> 25, (c & 0x1FFFFFF) << 5 ^ v
        for k, g in enumerate(BECH32_GENERATOR):
            if top >> k & 1:
                c ^= g
    return c


def bech32(hrp: str, version: int, program: bytes) -> str:
    """Of a witness program of version 0 (Bech32) or 1 (Bech32m)."""
    bits = "".join(f"{b:08b}" for b in program)
    bits += "0" * (-len(bits) % 5)
    data = [version] + [int(bits[k : k + 5], 2) for k in range(0, len(bits), 5)]
    head = [ord(c) >> 5 for c in hrp] + [0] + [ord(c) & 31 for c in hrp]
    check = _polymod(head + data + [0] * 6) ^ BECH32_FINAL[version]
    return f"{hrp}1" + "".join(BECH32[d] for d in data + [check >> 5 * (5 - k) & 31 for k in range(6)])


def valid_key(key: bytes) -> bool:
    """Whether the bytes are a public key on the curve, compressed or not."""
    if len(key) == 33 and key[0] in (2, 3):
        x = int.from_bytes(key[1:])
        y2 = (x**3 + 7) % PRIME
        return x < PRIME and pow(y2, (PRIME + 1) // 4, PRIME) ** 2 % PRIME == y2
    if len(key) == 65 and key[0] == 4:
        x, y = int.from_bytes(key[1:33]), int.from_bytes(key[33:])
        return x < PRIME and y < PRIME and (y * y - x**3 - 7) % PRIME == 0
    return False


def classify(script: bytes, network: str = "mainnet") -> tuple[str, str | None]:
    """Type and address of a script."""
    key_version, script_version, hrp = NETWORKS[network]
    n = len(script)
    if script[:1] == b"\x6a":
        return "NULL_DATA", None
    if n == 25 and script[:3] == b"\x76\xa9\x14" and script[23:] == b"\x88\xac":
        return "P2PKH", base58check(key_version, script[3:23])
    if n == 23 and script[:2] == b"\xa9\x14" and script[22:] == b"\x87":
        return "P2SH", base58check(script_version, script[2:22])
    if 4 <= n <= 42 and script[1] == n - 2 and (script[0] == 0 or 0x51 <= script[0] <= 0x60):
        kind = {0x00: {22: "P2WPKH", 34: "P2WSH"}.get(n), 0x51: "P2TR"}.get(script[0])
        return (kind, bech32(hrp, int(script[0] > 0), script[2:])) if kind else ("UNKNOWN", None)
    if n >= 2 and script[-1] == 0xAC and script[0] == n - 2 and valid_key(script[1:-1]):
        return "P2PK", base58check(key_version, hash160(script[1:-1]))
    return "UNKNOWN", None


def with_addresses(outputs: DataFrame, network: str = "mainnet", script: str = "script_pubkey") -> DataFrame:
    """outputs with script_type and address of their script (hex); each distinct script is encoded once.

    A null script or one that isn't hex is UNKNOWN, without an address.
    """
    if network not in NETWORKS:
        raise ValueError(f"unknown network {network}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for s in batch["_script"]:
                try:
                    found.append((s, *classify(bytes.fromhex(s), network)))
                except ValueError:
                    found.append((s, "UNKNOWN", None))
            yield pd.DataFrame(found, columns=["_script", "script_type", "address"])

    known = outputs.select(F.col(script).alias("_script")).where("_script is not null").distinct().mapInPandas(run, "_script string, script_type string, address string")
    rest = outputs.drop("script_type", "address")
    joined = rest.join(known, rest[script] == known["_script"], "left").drop("_script")
    return joined.withColumn("script_type", F.coalesce("script_type", F.lit("UNKNOWN")))
