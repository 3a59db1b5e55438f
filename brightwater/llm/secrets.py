"""Secret scan: pattern matches weighed by how many repositories and owners share them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwater.session import written


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KINDS = ["assign", "access", "hex", "owned"]
# Patterns of the base kinds (fixed values). Keys match in either case of A-Z only.
KEYS = "|".join(map(_either_case, ["password", "passwd", "secret", "token", "api_?key"]))
ASSIGN = re.compile(rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
WIDE = re.compile(r"[A-Za-z0-9+/_-]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_BITS = 12, 18, 3.5
CANDIDATE = "array<struct<kind:int,start:long,end:long,digest:string>>"


def _bits(value: str) -> float:
    """Entropy of a character of the value."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """Kind, start, end and value of each candidate, by start and kind; positions are code points.

    Base kinds are found by the patterns; other long tokens of high entropy
    with letters and digits are candidates of kind ``owned`` where no base span touches them.
    """
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda x: (x[1], x[0]))
    base, i, reach = found[:], 0, 0
    for m in WIDE.finditer(text):
        while i < len(base) and base[i][1] < m.end():
            reach = max(reach, base[i][2])
            i += 1
        value = m[0]
        if reach <= m.start() and any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and _bits(value) >= LEAST_BITS:
            found.append((3, m.start(), m.end(), value))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _scanned(documents: DataFrame, id_col: str, text_col: str, repository: Column, owner: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.string())]))
        for batch in batches:
            rows = [
                [{"kind": k, "start": a, "end": b, "digest": hashlib.blake2b(v.encode(), digest_size=16).hexdigest()} for k, a, b, v in candidates(t or "")]
                for t in batch.column(3).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(rows, kind)], names=["id", "repository", "owner", "found"])

    kind = documents.schema[id_col].dataType.simpleString()
    frame = documents.select(F.col(id_col).alias("id"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), F.col(text_col).alias("text"))
    return frame.mapInArrow(run, f"id {kind}, repository string, owner string, found {CANDIDATE}").withColumn("row", F.monotonically_increasing_id())


def find_secrets(
    documents: DataFrame,
    repository: Column,
    owner: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    live_owners: int = 1,
    copied_owners: int = 3,
) -> DataFrame:
    """Secrets in every whole text: ``id_col`` and ``secrets``, an array by start and kind.

    An element has ``start, rank, kind, end, repositories, owners`` and
    ``verdict``: ``live`` where ``live_owners`` owners at most have its value, ``copied`` from
    ``copied_owners`` on (an example that is passed around), else ``shared``. Base kinds are
    always listed; a candidate of kind ``owned`` only when it is live.

    Candidate values are counted as hashes, over all documents, by distinct
    repository and owner; repeated (value, repository, owner) rows are merged before the shuffle,
    so a value that a third of the documents hold is no one task's work. A null
    repository or owner is one of its own. A null or empty text has no secrets; repeated rows are
    scanned each; other columns are not read; an empty table gives no rows.
    """
    scanned = written(_scanned(documents, id_col, text_col, repository, owner), "scanned")
    listed = scanned.select("row", "repository", "owner", F.explode("found").alias("f")).select("row", "repository", "owner", "f.*")
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("repository", "owner")]
    seen = listed.select("digest", *named).distinct()
    counts = seen.groupBy("digest").agg(F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners"))
    judged = listed.join(written(counts, "ownership"), "digest")
    verdict = F.when(F.col("owners") <= live_owners, "live").when(F.col("owners") >= copied_owners, "copied").otherwise("shared")
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    judged = judged.withColumn("verdict", verdict).where(F.col("kind") < 3).unionByName(judged.withColumn("verdict", verdict).where("kind = 3 AND verdict = 'live'"))
    one = F.struct("start", F.col("kind").alias("rank"), name.alias("kind"), "end", "repositories", "owners", "verdict")
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("secrets"))
    empty = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long,repositories:long,owners:long,verdict:string>>")
    return scanned.join(by_row, "row", "left").select(F.col("id").alias(id_col), F.coalesce("secrets", empty).alias("secrets"))


def span_text(secrets: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
