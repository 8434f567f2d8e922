"""How models become tables: staging stays part of the plans that read it, intermediates and marts are written once and read back."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from veloframe.store import Store

Model = Callable[[Mapping[str, DataFrame]], DataFrame]

#: What is done with a model, and the schema it goes to, by the first part of its name.
POLICY = {"stg": ("inline", None), "int": ("table", "gold"), "mart": ("table", "gold")}


def policy(name: str, policies: Mapping[str, tuple[str, str | None]] = POLICY) -> tuple[str, str | None]:
    kind = name.split("_", 1)[0]
    if kind not in policies:
        raise ValueError(f"{name}: no policy for {kind}")
    return policies[kind]


def build(store: Store, models: Mapping[str, Model], sources: Mapping[str, DataFrame], policies: Mapping[str, tuple[str, str | None]] = POLICY) -> dict[str, DataFrame]:
    """All frames by name. Models run in the order given, each on what came before; the schema is taken as it is, with no prefix."""
    frames = dict(sources)
    for name, model in models.items():
        how, schema = policy(name, policies)
        frames[name] = model(frames)
        if how == "table":
            table = f"{schema}/{name}" if schema else name
            store.replace(table, frames[name])
            frames[name] = store.read(table)
    return frames
