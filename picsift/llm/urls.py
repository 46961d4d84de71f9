"""URL filters by a bit-parallel wildcard automaton (operator 9).

A rule (host, path) becomes two globs over the canonical URL ``host`` + ``path``:
``host path*`` and ``*.host path*``; the first star stays within the host.  All
globs are packed side by side into 64-bit words, one bit for each state, and
simulated at once (Shift-And with self-loops for the stars), over all URLs of a
batch: one step reads one byte of every URL that is still alive.

The masks (256 bytes x words) are broadcast with the rules, at most ``MAX_BITS``
states.  No shuffle; pages' other columns are not read.

Defined results: a null URL or one without ``://`` has an empty host and path, which no
rule fits; where no rule fits, the rule is null and the verdict ``allow``.  Of the rules
that fit, the longest text wins, then the first in the list.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import read

#: The registered query's rules: (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"
#: States of all globs together, at most (2 x 32 MB of masks).
MAX_BITS = 1 << 20
#: Words of state (URLs x words of the masks) that a task holds at a time, 16 MB an array.
SLICE_WORDS = 1 << 21


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``, else nothing."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


@dataclass
class Automaton:
    take: np.ndarray      # (256, words): states entered by reading a byte
    stay: np.ndarray      # (256, words): states that a byte doesn't leave
    start: np.ndarray     # (words,)
    ends: np.ndarray      # accepting bit of each glob
    owner: np.ndarray     # rule of each glob
    rules: list[str]
    verdicts: list[str]

    def fitting(self, urls: list[bytes]) -> np.ndarray:
        """Number of the winning rule of each URL, -1 where none fits."""
        size = np.fromiter(map(len, urls), dtype=np.int64, count=len(urls))
        order = np.argsort(-size, kind="stable")
        at = (np.cumsum(size) - size)[order]
        size = size[order]
        data = np.frombuffer(b"".join(urls), dtype=np.uint8)
        state = np.tile(self.start, (len(urls), 1))
        live = np.arange(len(urls))               # by length, longest first
        for step in range(int(size[0]) if len(size) else 0):
            live = live[:np.searchsorted(-size[live], -step, side="left")]
            if step % 16 == 15:
                live = live[state[live].any(axis=1)]
            if not len(live):
                break
            now = state[live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            byte = data[at[live] + step]
            state[live] = (moved & self.take[byte]) | (now & self.stay[byte])
        best = np.full(len(urls), -1, dtype=np.int64)
        rank = np.array(sorted(range(len(self.rules)), key=lambda r: (len(self.rules[r]), -r)), dtype=np.int64)
        value = np.empty(len(rank), dtype=np.int64)
        value[rank] = np.arange(len(rank))        # a rule that wins over others has a higher value
        for end, rule in zip(self.ends.tolist(), self.owner.tolist()):
            hit = (state[:, end >> 6] >> np.uint64(end & 63) & np.uint64(1)).astype(bool)
            best[order[hit]] = np.maximum(best[order[hit]], value[rule])
        return np.where(best >= 0, rank[best], -1) if len(rank) else best


def compile_rules(rules: tuple[tuple[str, str], ...]) -> Automaton:
    """Globs of all rules, packed into words."""
    globs = []
    for number, (_, rule) in enumerate(rules):
        host, slash, path = rule.partition("/")
        literal = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)).encode() + (slash + path).encode()
        globs.append((number, False, literal))
        globs.append((number, True, b"." + literal))
    bits = sum(len(g) + 1 for _, _, g in globs)
    if bits > MAX_BITS:
        raise ValueError(f"the rules need {bits} states, more than {MAX_BITS}")
    words = max(1, -(-bits // 64))
    take, stay = np.zeros((256, words), dtype=np.uint64), np.zeros((256, words), dtype=np.uint64)
    start = np.zeros(words, dtype=np.uint64)
    ends, owner = [], []
    at = 0

    def put(mask: np.ndarray, bit: int) -> None:
        mask[..., bit >> 6] |= np.uint64(1) << np.uint64(bit & 63)

    for number, anywhere, literal in globs:
        put(start, at)
        if anywhere:                                  # the star before the host
            slash = stay[ord("/")].copy()
            put(stay, at)
            stay[ord("/")] = slash
        for k, byte in enumerate(literal, 1):
            put(take[byte], at + k)
        put(stay, at + len(literal))                  # the star at the end
        ends.append(at + len(literal))
        owner.append(number)
        at += len(literal) + 1
    return Automaton(take, stay, start, np.array(ends, dtype=np.int64), np.array(owner, dtype=np.int64),
                     [r for _, r in rules], [v for v, _ in rules])


def judge(df: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url",
          keep: tuple[str, ...] = ("page_id",), default: str = DEFAULT) -> DataFrame:
    """Columns ``keep``, host, path, rule, verdict."""
    sent = df.sparkSession.sparkContext.broadcast(compile_rules(rules))
    parts = df.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    schema = StructType([*parts.schema, StructField("rule", StringType()), StructField("verdict", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        machine, out = sent.value, to_arrow_schema(schema)
        for batch in batches:
            urls = [(h + p).encode("utf-8", "surrogatepass") for h, p in zip(*(c.to_pylist() for c in batch.columns[-2:]))]
            many = max(1, SLICE_WORDS // len(machine.start))          # URLs whose states are held at a time
            won = [r for i in range(0, len(urls), many) for r in machine.fitting(urls[i:i + many]).tolist()]
            added = [pa.array([machine.rules[r] if r >= 0 else None for r in won], pa.string()),
                     pa.array([machine.verdicts[r] if r >= 0 else default for r in won], pa.string())]
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, out)), *added], schema=out)

    return parts.mapInArrow(run, schema)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
