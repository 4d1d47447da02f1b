"""Field catalogs: which fields a table has and what they are called on screen."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame

Catalog = dict[str, dict[str, str]]


def load_catalog(path: str) -> Catalog:
    """Fields under properties.data.properties of a JSON catalog, or of YAML where a reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML catalogs needs a YAML reader; JSON needs none") from error
        tree = yaml.safe_load(text)
    else:
        tree = json.loads(text)
    return tree.get("properties", {}).get("data", {}).get("properties", {})


def known_fields(wanted: list[str], catalog: Catalog, strict: bool = False) -> list[str]:
    """The wanted fields the catalog has, in the order asked for; ``strict`` raises when none is left."""
    fields = [f for f in dict.fromkeys(wanted) if f in catalog]
    if strict and not fields:
        raise ValueError("none of the wanted fields is in the catalog")
    return fields


def select_known_fields(df: DataFrame, wanted: list[str], catalog: Catalog, strict: bool = False) -> DataFrame:
    return df.select(*known_fields(wanted, catalog, strict))


def friendly_names(df: DataFrame, catalog: Catalog) -> DataFrame:
    """Columns renamed to their titles; those the catalog does not know keep their name."""
    return df.withColumnsRenamed({c: catalog[c]["title"] for c in df.columns if catalog.get(c, {}).get("title")})
