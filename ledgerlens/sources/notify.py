"""A node's announcements of new blocks: a subscriber of its message queue (ZMTP 3.0 over TCP, no security mechanism)."""

from __future__ import annotations

import socket
import struct
import time
from collections.abc import Iterator

from ledgerlens.sources import codec

MORE, LONG, COMMAND = 1, 2, 4  # fixed values: bits of a frame's first byte
MOST_FRAME = 1 << 20


def greeting() -> bytes:
    return b"\xff" + bytes(8) + b"\x7f" + b"\x03\x00" + b"NULL".ljust(20, b"\0") + bytes(32)


def frame(body: bytes, flags: int = 0) -> bytes:
    head = struct.pack(">BB", flags, len(body)) if len(body) < 256 else struct.pack(">BQ", flags | LONG, len(body))
    return head + body


def ready(kind: bytes) -> bytes:
    """The command that ends the handshake, with the socket's type."""
    return frame(b"\x05READY" + b"\x0bSocket-Type" + struct.pack(">I", len(kind)) + kind, COMMAND)


class Subscriber:
    """Messages of a topic as lists of frames. Connects at first use, and again (after each of waits in turn) where the connection fails."""

    def __init__(self, address: str, topic: bytes = b"hashblock", timeout: float = 30, waits: tuple[float, ...] = (1, 2, 5)):
        scheme, _, place = address.partition("://")
        host, _, port = place.rpartition(":")
        if scheme != "tcp" or not host or not port.isdigit():
            raise ValueError(f"{address} isn't tcp://host:port")
        self.place, self.topic, self.timeout, self.waits = (host, int(port)), topic, timeout, waits
        self.sock: socket.socket | None = None
        self.last: int | None = None

    def close(self) -> None:
        if self.sock:
            self.sock.close()
        self.sock = None

    def _exactly(self, n: int) -> bytes:
        out = bytearray()
        while len(out) < n:
            part = self.sock.recv(n - len(out))
            if not part:
                raise ConnectionError("the node closed the connection")
            out += part
        return bytes(out)

    def _frame(self) -> tuple[int, bytes]:
        flags = self._exactly(1)[0]
        size = struct.unpack(">Q", self._exactly(8))[0] if flags & LONG else self._exactly(1)[0]
        if size > MOST_FRAME:
            raise ConnectionError(f"a frame of {size} bytes")
        return flags, self._exactly(size)

    def _connect(self) -> None:
        self.sock = socket.create_connection(self.place, self.timeout)
        self.sock.sendall(greeting())
        theirs = self._exactly(64)
        if theirs[0] != 0xFF or theirs[9] != 0x7F or theirs[10] < 3 or theirs[12:32].rstrip(b"\0") != b"NULL":
            raise ConnectionError("the other side doesn't speak ZMTP 3 without security")
        self.sock.sendall(ready(b"SUB"))
        flags, body = self._frame()
        if not flags & COMMAND or not body.startswith(b"\x05READY"):
            raise ConnectionError("no READY")
        self.sock.sendall(frame(b"\x01" + self.topic))

    def receive(self, wait: float) -> list[bytes] | None:
        """The next message, or None if none comes in so many seconds. OSError where the node can't be reached after all waits."""
        end = time.monotonic() + wait
        tries = iter((*self.waits, None))
        while True:
            try:
                if self.sock is None:
                    self._connect()
                left = end - time.monotonic()
                if left <= 0:
                    return None
                self.sock.settimeout(left)
                try:
                    first = self.sock.recv(1, socket.MSG_PEEK)
                except TimeoutError:
                    return None
                if not first:
                    raise ConnectionError("the node closed the connection")
                self.sock.settimeout(self.timeout)
                frames, flags = [], MORE
                while flags & MORE:
                    flags, body = self._frame()
                    if flags & COMMAND:
                        flags = MORE if not frames else flags
                        continue
                    frames.append(body)
                return frames
            except OSError:
                self.close()
                pause = next(tries, None)
                if pause is None:
                    raise
                time.sleep(pause)

    def announcements(self, wait: float) -> Iterator[tuple[str, int | None, int | None]]:
        """(hash, number, expected number where it isn't the one after the last) until none comes in so many seconds; messages that can't be read are left out."""
        while (frames := self.receive(wait)) is not None:
            try:
                block, number = codec.notification(frames)
            except codec.BadBytes:
                continue
            expected = None if self.last is None or number is None else (self.last + 1) % 2**32
            self.last = number if number is not None else self.last
            yield block, number, expected if expected != number else None

    def wake(self, wait: float) -> None:
        """For follow: returns at the next announcement, or after so many seconds; where the node can't be reached, after them, too."""
        end = time.monotonic() + wait
        try:
            next(self.announcements(wait), None)
        except OSError:
            time.sleep(max(0, end - time.monotonic()))
