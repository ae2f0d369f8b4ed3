"""Stable identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
# Prefixes of element ids.
ELEMENT_PREFIX = {"figure": "fig", "table": "tbl", "isolate_formula": "eq"}


def chunk_id(paper: Column, node: Column, sub: Column) -> Column:
    return F.concat_ws(":", paper, node, sub.cast("string"))


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version 5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def element_id(kind: Column, node: Column, page: Column, nth: Column) -> Column:
    prefix = F.coalesce(*(F.when(kind == k, F.lit(p)) for k, p in ELEMENT_PREFIX.items()), F.lit("el"))
    return F.format_string("%s_%s_%04d_%03d", prefix, node, page.cast("int"), nth.cast("int"))


def node_id(nth: Column) -> Column:
    """Four digits at least; larger numbers keep all of theirs."""
    return F.format_string("%04d", nth.cast("int"))


def shard_id(batch: Column, shard: Column) -> Column:
    return F.format_string("%s-shard-%04d", batch, shard.cast("int"))


def item_id(batch: Column, document: Column) -> Column:
    return F.concat(batch, F.lit("-pdf-"), document)


def valid_id(name: Column) -> Column:
    """Letters and digits of any script, hyphen and underscore; not empty."""
    return F.coalesce(F.rlike(name, F.lit(r"^[\p{L}\p{N}_-]+$")), F.lit(False))
