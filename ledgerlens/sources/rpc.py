"""Blocks from a node's JSON interface."""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources import block_files, codec

OUT_OF_RANGE = -8  # fixed value: the interface's code for a height beyond the tip


class RpcError(RuntimeError):
    def __init__(self, code: int, message: str):
        super().__init__(f"{message} ({code})")
        self.code = code


@dataclass(frozen=True)
class Node:
    """post takes the request's bytes and returns the answer's; by default over HTTP."""

    url: str
    user: str = ""
    password: str = ""
    timeout: float = 30
    waits: tuple[float, ...] = (1, 2)
    post: Callable[[bytes], bytes] | None = None

    def _post(self, body: bytes) -> bytes:
        if self.post:
            return self.post(body)
        token = base64.b64encode(f"{self.user}:{self.password}".encode()).decode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Basic {token}"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:  # errors of calls come with status 500 and a body
            if e.code == 500:
                return e.read()
            if e.code in (401, 403):
                raise RpcError(e.code, "the node refuses these credentials") from e
            raise

    def call(self, method: str, *params):
        """The result; transport failures are tried again after each wait, an error the node reports isn't."""
        body = json.dumps({"jsonrpc": "1.0", "id": 0, "method": method, "params": params}).encode()
        for wait in (*self.waits, None):
            try:
                answer = json.loads(self._post(body))
                break
            except OSError:
                if wait is None:
                    raise
                time.sleep(wait)
        if answer.get("error"):
            raise RpcError(answer["error"].get("code", 0), answer["error"].get("message", ""))
        return answer["result"]

    def tip_height(self) -> int:
        return self.call("getblockcount")

    def block_hash(self, height: int) -> str | None:
        try:
            return self.call("getblockhash", height)
        except RpcError as e:
            if e.code == OUT_OF_RANGE:
                return None
            raise

    def block(self, height: int) -> bytes | None:
        block_hash = self.block_hash(height)
        return None if block_hash is None else bytes.fromhex(self.call("getblock", block_hash, 0))


def rpc_blocks(spark: SparkSession, node: Node, start: int, count: int, partitions: int = 8) -> DataFrame:
    """height and the block of each of count heights from start, in their order; heights past the tip are left out.

    partitions bounds the requests at once; each has a stretch of consecutive heights.
    """
    ddl = "height long, " + block_files.BLOCK
    schema = pa.schema([("height", pa.int64()), *block_files._fields(spark)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for height in batch.column(0).to_pylist():
                block = node.block(height)
                if block is not None:
                    yield pa.RecordBatch.from_pylist([{"height": height, "file": None, "offset": None} | codec.read_block(block)], schema=schema)

    return spark.range(start, start + count, 1, partitions).mapInArrow(run, ddl)
