"""Spelling variant grouping by a relational trie frontier (operator 12).

Two words are near if one inserted, deleted or replaced character turns one into the other.
Words lie in a trie that is an edge table: (node, label, child), spread over the cluster.  A
frontier of states (word, position, node, edits) is joined with the edge table
level by level; a state follows an edge whose label it matches, or spends its one edit on
replacing or deleting a character of the word.  A state with one edit that ends its word at the end of another
has found a neighbour.  An insertion is the other word's deletion, and a replacement is looked for
towards the larger character, so each link is found from one side.

Two things keep the frontier small.  Words are in two tries, one of them reversed, and each allows its edit
in the second half of the word only, where few words still share the way; a node is named by the hash of its
prefix, so a word's frontier starts at the node of its first half, and the tries hold the second halves.
And nodes with a single child where no word ends and no word's frontier starts are left out, so an edge's label has one
character or more and the number of levels is that of the forks on a word's way, not of its characters.

Scale and skew: words are counted with partial counts, so a common word is no matter.  States and edges
are joined on the node; both sides are stored tables, so Spark splits a node that many words pass.  Each level
is written to the shared folder.  Nodes' names are 64-bit hashes; a collision could only add pairs, and every pair
is verified.

Defined results: a null or empty text has no words; a null id counts as the empty string in the hash
that picks runs; repeated rows count again; where no word is left the result is empty.  Of
near words with the largest count the smallest in code-point order is the form.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import portions, read, stored

#: The contract's values: shortest word, least occurrences, share of the runs that lose a character.
SHORTEST, OCCURRENCES, EVERY = 5, 3, 97
#: Characters of a text whose runs are held at a time.
CUT = 1 << 20
#: Words whose prefixes are hashed at a time; rows emitted at once.
WORDS, ROWS = 4096, 1 << 16

_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def runs(text: str | None, shortest: int = 1) -> Iterator[list[str]]:
    """The lower-cased runs of a text of ``shortest`` characters or more, those of about ``CUT`` characters at a time."""
    of = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")
    text, at = text or "", 0
    while at < len(text):
        end = len(text)
        if end - at > CUT:
            stop = _BREAK.search(text, at + CUT)
            end = stop.start() if stop else end
        yield of.findall(text[at:end].encode("utf-8").translate(_LOWER).decode("utf-8"))
        at = end


def word_of(prefix: int, run: str, every: int = EVERY) -> str:
    """The run, or the run without one character; ``prefix`` is the CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode("utf-8"), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST,
                occurrences: int = OCCURRENCES, every: int = EVERY) -> DataFrame:
    """(word, n): the words and their occurrences in all rows."""
    if shortest < 3:
        raise ValueError("words need three characters, so that each has a second half to edit")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in portions(batch.column(1)):
                total: Counter[str] = Counter()
                for i, t in enumerate(texts, first):
                    prefix = zlib.crc32(f"{'' if ids[i] is None else ids[i]}:".encode())
                    for part in runs(t, shortest):                # a run only gets shorter
                        for run, n in Counter(part).items():
                            word = word_of(prefix, run, every)
                            if len(word) >= shortest:
                                total[word] += n
                if total:
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    part = df.select(F.col(doc_id).cast("string"), text).mapInArrow(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def half_of(size: int, back: bool) -> int:
    """Characters of a word of ``size`` before the half in which the trie allows an edit; the two
    tries together allow it everywhere."""
    return (size + back) // 2


def _prefixes(words: list[str], salt: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word and length t from ``first`` (0) to its whole: number of the word, t, hash of its first t characters."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    first = np.zeros(len(words), dtype=np.int64) if first is None else first
    chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(len(chars)) - np.repeat(begin, sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((chars + np.uint64(1)) * powers[at], dtype=np.uint64)])
    many = sizes + 1 - first
    which = np.repeat(np.arange(len(words)), many)
    t = np.arange(len(which)) - np.repeat(np.cumsum(many) - many - first, many)
    z = total[begin[which] + t] - total[begin[which]] + t.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return which, t, (z ^ (z >> np.uint64(29))).view(np.int64)


def trie_ways(words: DataFrame) -> DataFrame:
    """(number, back, t, node, kind, next): each word's ways through the second halves of both tries, a node for every
    length t; ``next`` is the character after it, ``kind`` 0 where the way starts, 2 where it ends, else 1."""
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, WORDS):
                numbers = batch.column(0).slice(start, WORDS).to_numpy()
                those = batch.column(1).slice(start, WORDS).to_pylist()
                for back in (False, True):
                    ways = [w[::-1] for w in those] if back else those
                    sizes = np.fromiter(map(len, ways), dtype=np.int64, count=len(ways))
                    first = (sizes + back) // 2
                    which, t, node = _prefixes(ways, int(back), first)
                    after = np.frombuffer("".join(w[half_of(len(w), back):] + "\0" for w in ways).encode("utf-32-le"), dtype="<i4")
                    kind = np.where(after == 0, 2, np.where(t == first[which], 0, 1)).astype(np.int8)
                    for cut in range(0, len(which), ROWS):
                        here = slice(cut, cut + ROWS)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(numbers[which[here]]), pa.array(np.full(len(which[here]), back)), pa.array(t[here].astype(np.int32)),
                             pa.array(node[here]), pa.array(kind[here]), pa.array(after[here])],
                            names=["number", "back", "t", "node", "kind", "next"])

    return words.select("number", "word").mapInArrow(expand, "number long, back boolean, t int, node long, kind byte, next int")


def trie_edges(words: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """For words (number, word): the edge table (node, first, label, child, after, ends), where ``after`` has the first
    characters of the child's edges and ``ends`` is the way that ends at the child; the states (way, back, pos, node) that the words start in; and the number of levels."""
    ways = stored(trie_ways(words))
    # nodes where ways part, and nodes that some word ends or starts at while others go on
    kept = stored(ways.groupBy("node").agg(F.min("next").alias("least"), F.max("next").alias("most"), F.min("kind").alias("kind"))
                  .filter((F.col("least") != F.col("most")) | (F.col("kind") == 0)).select("node"))
    inner = F.col("kind") == 1
    rows = ways.filter(inner).join(kept, "node").select("number", "back", "t", "node").unionByName(
        ways.filter(~inner).select("number", "back", "t", "node"))
    steps = F.sort_array(F.collect_list(F.struct("t", "node")))          # of one word: as many as it has forks
    paths = stored(rows.groupBy("number", "back").agg(steps.alias("steps")).join(words, "number")
                   .select(F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("way"), "back", "steps"))
    levels = paths.agg(F.max(F.size("steps"))).first()[0] or 1
    pairs = F.transform(F.slice("steps", 1, F.size("steps") - 1), lambda s, i: F.struct(
        s["node"].alias("node"), F.get("steps", i + 1)["node"].alias("child"),
        F.substring("way", s["t"] + 1, F.get("steps", i + 1)["t"] - s["t"]).alias("label"),
        F.when(i == F.size("steps") - 2, F.col("way")).alias("ends")))
    edges = stored(paths.select(F.explode(pairs).alias("e")).select("e.*").groupBy("node", "child", "label").agg(F.max("ends").alias("ends"))
                   .withColumn("first", F.substring("label", 1, 1)))
    after = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set("first"), "").alias("after"))     # of one alphabet
    edges = edges.join(after, "child", "left")
    begin = F.get("steps", F.lit(0))
    return (edges.select("node", "first", "label", "child", "after", "ends"),
            paths.select("way", "back", begin["t"].alias("pos"), begin["node"].alias("node")), levels - 1)


def _one_step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states that follow, each at the child of an edge."""
    e = edges.select(F.col("node").alias("at"), "first", "label", "child", "after", "ends")
    s = states.select("way", "back", "pos", "node", "edits", F.substring("way", F.col("pos") + 1, F.lit(1)).alias("char"))
    rows = s.join(e, (F.col("node") == F.col("at")) & ((F.col("edits") == 0) | (F.col("char") == F.col("first"))))
    m, rest = F.length("label"), F.length("way") - F.col("pos")
    seg = F.substring("way", F.col("pos") + 1, m)
    same = seg == F.col("label")
    open_ = (F.col("edits") == 0) & ~same
    one = F.when(m == 1, F.lit(True)).otherwise(F.levenshtein(seg, F.col("label"), 1) == 1)
    replaced = open_ & (rest >= m) & (F.col("label") > seg) & one
    # the last character of a run of equal ones is the one that is deleted: the first label without it follows
    without = F.when(m == 1, F.substring("way", F.col("pos") + 2, F.lit(1)) == F.col("label")).otherwise(
        F.levenshtein(F.substring("way", F.col("pos") + 1, m + 1), F.col("label"), 1) == 1)
    deleted = open_ & (rest > m) & without

    def to(cond: Column, moved: Column, edits: Column) -> Column:
        # a state with its edit spent lives if it has found a word, or if an edge goes on with its next character
        on = F.when(moved == rest, F.col("ends").isNotNull()).otherwise(F.instr(F.col("after"), F.substring("way", F.col("pos") + moved + 1, F.lit(1))) > 0)
        return F.when(cond & ((edits == 0) | on), F.struct((F.col("pos") + moved).cast("int").alias("pos"), edits.cast("int").alias("edits")))

    outcomes = F.array_compact(F.array(to(same, m, F.col("edits")), to(replaced, m, F.lit(1)), to(deleted, m + 1, F.lit(1))))
    return (rows.select("way", "back", F.explode(outcomes).alias("o"), "child", "ends")
            .select("way", "back", F.col("o.pos").alias("pos"), F.col("child").alias("node"), F.col("ends").alias("at_way"), F.col("o.edits").alias("edits")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) for all near pairs of the different words of ``words``, of three characters or more, in both orders."""
    numbered = stored(words.select(F.monotonically_increasing_id().alias("number"), "word"))
    edges, start, levels = trie_edges(numbered)
    edges = stored(edges)
    states = start.select("way", "back", "pos", "node", F.lit(None).cast("string").alias("at_way"), F.lit(0).alias("edits"))
    found = []
    for _ in range(levels):
        states = stored(_one_step(states, edges))
        done = F.length("way") == F.col("pos")
        found.append(states.filter(F.col("at_way").isNotNull() & ((done & (F.col("edits") == 1))
                     | ((F.col("edits") == 0) & (F.col("pos") == F.length("way") - 1))))     # its last character deleted
                     .select("way", "at_way", "back"))
        states = states.filter(~done)
    if not found:
        return words.select("word", F.col("word").alias("near")).limit(0)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    read = [F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)) for c in ("way", "at_way")]
    pairs = pairs.filter(F.levenshtein("way", "at_way", 1) == 1).select(F.least(*read).alias("a"), F.greatest(*read).alias("b")).distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def group_variants(counts: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``counts`` (word, n)."""
    words = stored(counts)
    near = near_words(words)
    other = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    best = (near.join(other, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("w"))).alias("best")))
    larger = -F.col("best.m") >= 2 * F.col("n")
    named = stored(words.join(best, "word", "left")
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(larger, F.col("best.w")).alias("form"), F.when(larger, -F.col("best.m")).alias("form_n")))
    # a form has at least twice the count, so a chain has no more links than the largest count has bits: pointers jump
    most = words.agg(F.max("n")).first()[0] or 1
    roots = named.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(most.bit_length() + 1)))):
        roots = stored(roots)
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return (named.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(read(spark, sf_dir, "documents")))
