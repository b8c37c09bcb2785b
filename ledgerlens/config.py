"""Settings from a TOML file, overridden by LEDGERLENS_SECTION__NAME variables."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass


class ConfigError(ValueError):
    pass


@dataclass
class Source:
    blocks: str = ""
    network: str = "mainnet"
    start_height: int = 0
    end_height: int = -1  # -1: the tip


@dataclass
class StoreSettings:
    root: str = ""
    max_transaction_memory_mb: int = 256
    auto_resume: bool = True


@dataclass
class Rpc:
    url: str = ""
    user: str = ""
    password: str = ""
    notify: str = ""
    timeout_secs: int = 30
    batch_size: int = 100


@dataclass
class Config:
    source: Source = field(default_factory=Source)
    store: StoreSettings = field(default_factory=StoreSettings)
    rpc: Rpc | None = None

    def validate(self) -> Config:
        _need(self.store.root, "store.root is empty")
        _need(self.source.network in ("mainnet", "testnet", "regtest"), f"unknown network {self.source.network}")
        _need(self.source.start_height >= 0, "source.start_height is negative")
        _need(self.store.max_transaction_memory_mb > 0, "store.max_transaction_memory_mb must be positive")
        return self

    def validate_rpc(self) -> Config:
        """What the live mode needs besides."""
        _need(self.rpc, "a section [rpc] is needed")
        _need(self.rpc.url, "rpc.url is empty")
        _need(self.rpc.notify, "rpc.notify is empty")
        _need(self.rpc.timeout_secs > 0, "rpc.timeout_secs must be positive")
        _need(self.rpc.batch_size > 0, "rpc.batch_size must be positive")
        return self


def _need(ok: object, why: str) -> None:
    if not ok:
        raise ConfigError(why)


def _typed(kind: type, name: str, value: object) -> object:
    if isinstance(value, str) and kind is not str:
        try:
            return {"true": True, "false": False}[value.lower()] if kind is bool else kind(value)
        except (KeyError, ValueError):
            raise ConfigError(f"{name}: {value!r} isn't a {kind.__name__}") from None
    _need(type(value) is kind, f"{name}: {value!r} isn't a {kind.__name__}")
    return value


def load(path: str | None = None, env: Mapping[str, str] = os.environ) -> Config:
    """Defaults, then the file, then the environment; unknown sections and names are errors."""
    raw: dict[str, dict] = {}
    if path:
        with open(path, "rb") as f:
            raw = tomllib.load(f)
    for key, value in env.items():
        if key.startswith("LEDGERLENS_") and "__" in key:
            section, name = key.removeprefix("LEDGERLENS_").lower().split("__", 1)
            raw.setdefault(section, {})[name] = value
    out, kinds = Config(), {"source": Source, "store": StoreSettings, "rpc": Rpc}
    for section, values in raw.items():
        _need(section in kinds and isinstance(values, dict), f"unknown section {section}")
        own = getattr(out, section) or kinds[section]()
        known = {f.name: type(getattr(own, f.name)) for f in fields(own) if not is_dataclass(f.type)}
        for name, value in values.items():
            _need(name in known, f"unknown setting {section}.{name}")
            setattr(own, name, _typed(known[name], f"{section}.{name}", value))
        setattr(out, section, own)
    return out
