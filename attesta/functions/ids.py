"""Content-derived identifiers: Column -> Column. Never counters, so a rerun gives the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attesta.functions.text import as_col, nname


def _text(c) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def h10(*parts) -> Column:
    """The first ten hex digits of the sha1 of the pipe-joined parts."""
    return F.substring(F.sha1(F.concat_ws("|", *[_text(p) for p in parts])), 1, 10)


def posting_id(account, req, city, role) -> Column:
    """The request id when there is one, else a hash of city and role."""
    return F.when(_text(req) != "", F.concat(as_col(account), F.lit("--jr-"), as_col(req))).otherwise(
        F.concat(as_col(account), F.lit("--jr-h"), h10(city, role)))


def unit_id(account, unit_slug) -> Column:
    return F.concat(as_col(account), F.lit("--ou-"), as_col(unit_slug))


def edge_id(account, edge_type, src, dst) -> Column:
    return F.concat(as_col(account), F.lit("--oe-"), as_col(edge_type), F.lit("-"), h10(src, dst))


def item_id(url) -> Column:
    return F.sha1(as_col(url))


def _named(owner, mark: str, name) -> Column:
    """Owner, the first letters of a name to read, and a hash of all of them to tell names apart."""
    return F.concat(as_col(owner), F.lit(mark), F.substring(nname(name), 1, 24), F.lit("-"), h10(nname(name)))


def role_head_id(site, name) -> Column:
    return _named(site, "--rh-", name)


def target_id(account, name) -> Column:
    return _named(account, "--ct-", name)


def request_hash(*parts) -> Column:
    """24 hex digits of the sha256 of the canonical JSON of the parts, fields in name order."""
    return F.substring(F.sha2(F.to_json(F.struct(*parts)), 256), 1, 24)
