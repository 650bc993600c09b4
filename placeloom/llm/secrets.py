"""Secrets in texts, and how widely each is copied.

Candidates are found text by text; their hashes are then counted over the whole
corpus by distinct repositories and owners. A value that several owners have is
a copied example; one that a single owner has looks live.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from placeloom.llm.common import spans_text, stage

KINDS = ("assign", "access", "hex", "token", "jwt", "pem")
BASE = KINDS[:3]
#: A value that as many owners have is a widely copied example.
MANY_OWNERS = 3

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Prefixes of well-known credentials.
_TOKEN = re.compile(r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|AIza|npm_|hf_)[A-Za-z0-9_-]{16,}")
#: Three runs with dots between; the first is taken whole and searched once for where the token begins.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{11,}+)(?=(\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+))")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")


def find_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, the secret itself), by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), k, m.end(), m[0]) for k, p in ((1, _ACCESS), (2, _HEX), (3, _TOKEN), (5, _PEM)) for m in p.finditer(text)]
    end = 0
    for m in _JWT.finditer(text):
        at = text.find("eyJ", m.start(), m.end())
        if at >= end and m.end() - at >= 11:
            end = m.end(2)
            out.append((at, 4, end, text[at:end]))
    return sorted(out)


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("key", pa.string())]))


@F.arrow_udf(from_arrow_type(_TYPE))
def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array(
            [[{"kind": KINDS[k], "start": s, "end": e, "key": hashlib.sha256(x.encode("utf-8", "replace")).hexdigest()[:32]} for s, k, e, x in find_spans(t.as_py())] for t in texts],
            _TYPE,
        )


def secret_spans(text: Column) -> Column:
    """array<struct<kind,start,end,key>> by start, then kind; key is a hash of the secret. Null and empty texts: empty."""
    return _spans(text)


def ownership(candidates: DataFrame) -> DataFrame:
    """key, n_repos, n_owners over candidates(key, owner, repo): distinct ones; nulls count as one owner or repository.

    Each step groups by more than the key first, so a value that a third of all rows hold is counted in parts.
    """
    distinct = lambda c: candidates.select("key", c).distinct().groupBy("key").agg(F.count(F.lit(1)).alias(f"n_{c}s"))
    return distinct("repo").join(distinct("owner"), "key")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", many_owners: int = MANY_OWNERS
) -> DataFrame:
    """One row for each row of docs: id_col, found (spans), live and copied (how many of the spans), and the most
    repositories and owners that any of them has.

    A span is copied if as many owners as many_owners have its value, in as many repositories at least; else it looks
    live. By default a document is a repository of its own, and its source is the owner: repositories are then documents.

    Repeated rows stay repeated and count as one repository; null ids, owners and texts are allowed; further columns
    are not read; an empty table gives an empty one. The texts are scanned once: spans are staged in the shared folder.
    """
    found = stage(
        docs.select(
            F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(repo_col).cast("string").alias("repo"), secret_spans(F.col(text_col)).alias("found")
        ).withColumn("row", F.monotonically_increasing_id()),
        "secrets",
    )
    each = found.where(F.size("found") > 0).select("row", "owner", "repo", F.explode("found.key").alias("key"))
    verdicts = ownership(each).select("key", "n_repos", "n_owners", (F.least("n_owners", "n_repos") >= many_owners).alias("is_copied"))
    counted = each.select("row", "key").join(verdicts, "key").groupBy("row").agg(F.count_if("is_copied").alias("copied"), F.count_if(~F.col("is_copied")).alias("live"), F.max("n_repos").alias("n_repos"), F.max("n_owners").alias("n_owners"))
    return found.join(counted, "row", "left").select(
        F.col("id").alias(id_col), "found", F.coalesce("live", F.lit(0)).alias("live"), F.coalesce("copied", F.lit(0)).alias("copied"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_repos", "n_owners")]
    )


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the base kinds, all spans, and how many look live or copied."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        *[n(k).alias(f"n_{k}") for k in BASE],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
        F.col("live").cast("long").alias("n_live"),
        F.col("copied").cast("long").alias("n_copied"),
        "n_repos",
        "n_owners",
    )
