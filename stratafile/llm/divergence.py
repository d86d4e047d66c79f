"""Source divergence audit: how far the sources of a language are from each other and from the whole, by their terms.

Each language keeps the terms that occur in at least ``LEAST_DOCS`` of its documents (rows). A group is a (lang, source);
with N occurrences of kept terms and V kept terms it gives a term that occurs c times the share
p = 1 + floor(10^9 (c + 1) / (N + V)), so a term that doesn't occur has the group's zero share z. The distance of p from q is
f(p, q) = floor((p - q)^2 / q); the distance of group g from a peer h is the sum of f over all kept terms.

1. Terms are counted on the executors, per group and over many documents at a time, and go into one shuffle as sums.
2. The kept counts, term by term, are the term-major index: a term's postings are the groups that hold it.
3. Peers, Gustavson's way: tasks hold blocks of whole terms. A group scatters its terms of a block through the index into
   a dense array with a place for each peer. Only that row of sums leaves the task, never a pair of postings.
   What is scattered corrects a baseline, f(p, p') - f(p, z') - f(z, p') + f(z, z'), where z and z' are the zero shares.
4. The baseline takes both groups as if they shared no term. It needs a group's shares with their numbers only, not its
   terms: the sum of f(p, z') over the shares of g, of f(z, p') over those of h, and f(z, z') for each term of neither.
5. Terms: a group's kept terms by f(p, q), q the share of its whole language, where p > q; the highest ``TOP`` ones.

All of it is integer arithmetic. Shares are divided as decimals, sums of a task stay below 2^63 (up to a billion kept terms a
language), and sums over tasks are decimals.

A group with a third of all documents is counted in pieces, since step 1 sums per task. Postings are as many as
(group, kept term) pairs; a block holds whole terms, a term at most one posting a source. The result has a row for each two
sources of a language; steps 3 and 4 take memory in proportion to one row of it.

Defined results: a null text, lang or source is ''; repeated rows are documents of their own; a group without a kept term
has the share 1 + floor(10^9 / V) for each; in a language without kept terms all distances are 0 and there is no term row;
a source that is alone in its language has no pair row; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafile.llm.tables import stored
from stratafile.llm.words import rounds

SCALE, LEAST_DOCS, TOP = 1_000_000_000, 3, 200
#: Entries that a counting task holds before it sends them on; bytes of a text that are looked at once; postings of a round.
HELD, SEGMENT, ROUND = 1 << 18, 1 << 20, 1 << 19

#: On UTF-8 in lower case: letters, and all bytes of characters beyond ASCII. No separator lies within a character.
TERM, SEPARATOR = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")


def segments(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about SEGMENT bytes, cut between terms."""
    at = 0
    while at < len(data):
        cut = SEPARATOR.search(data, at + SEGMENT)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def _flush(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (occurrences, documents) in held.items():
        terms = [None, *occurrences]  # the row without a term says that the group occurs
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *occurrences.values()], pa.int64()), pa.array([0, *map(documents.__getitem__, occurrences)], pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )
    held.clear()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0
    for batch in rounds(batches):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(occurrences), set()
            for piece in segments(text.encode().lower()):
                found = TERM.findall(piece)
                occurrences.update(found)
                own.update(found)
            documents.update(own)
            entries += len(occurrences) - before + 1
            if entries >= HELD:
                yield from _flush(held)
                entries = 0
    yield from _flush(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents that hold it. A row with a
    null term stands for the group itself."""
    given = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    rows = given.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total), exactly."""
    return F.lit(1) + F.call_function("div", (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(19,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def scatter(term: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray, peers: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each group its row of corrections, a place for each peer, over postings in the order of their terms.

    term: ascending numbers; zero: the posting's group's zero share.
    """
    begins = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    lengths = np.diff(np.append(begins, len(term)))
    of = np.repeat(np.arange(len(begins)), lengths)  # the index row of each posting
    by_group = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(group[by_group]) != 0))
    for a, b in zip(cuts, np.append(cuts[1:], len(group)), strict=True):
        own = by_group[a:b]
        rows = of[own]
        sizes = lengths[rows]
        skip = np.repeat(begins[rows] - (np.cumsum(sizes) - sizes), sizes)
        met = skip + np.arange(len(skip))  # postings of all terms of the group
        mine, none = np.repeat(p[own], sizes), zero[own[0]]
        their, empty = p[met], zero[met]
        sums = np.zeros(peers, np.int64)
        np.add.at(sums, group[met], _f(mine, their) - _f(mine, empty) - _f(none, their) + _f(none, empty))
        yield int(group[own[0]]), sums


def _pairs(lang: list, g: list, h: list, value: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(np.concatenate(g), pa.int32()), pa.array(np.concatenate(h), pa.int32()), pa.array(np.concatenate(value), pa.int64())],
        ["lang", "g", "h", "value"],
    )


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by (lang, term): the rows of sums of each round, a round being whole terms of one language."""

    def whole_terms() -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < ROUND:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.slice(size - 1)
            at = size - 1  # back to where the last term begins
            while at and table["term"][at - 1] == last["term"][0] and table["lang"][at - 1] == last["lang"][0]:
                at -= 1
            if at:
                yield table.slice(0, at)
            held, size = table.slice(at).to_batches(), size - at
        if size:
            yield pa.Table.from_batches(held).combine_chunks()

    for table in whole_terms():
        n = table.num_rows
        changes = np.ones(n, bool)
        langs, terms = (table[c].combine_chunks() for c in ("lang", "term"))
        langs, terms = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (langs, terms))
        other = pc.not_equal(langs[1:], langs[:-1]).to_numpy(zero_copy_only=False)
        changes[1:] = other | pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)
        number = np.cumsum(changes)
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), n]
        group, p, zero, peers = (table[c].to_numpy() for c in ("g", "p", "z", "peers"))
        for a, b in zip(edges, edges[1:], strict=False):
            out: tuple[list, list, list] = ([], [], [])
            for own, sums in scatter(number[a:b], group[a:b], p[a:b], zero[a:b], int(peers[a])):
                sums[own] = 0
                there = np.flatnonzero(sums)
                for column, values in zip(out, (np.full(len(there), own), there, sums[there]), strict=True):
                    column.append(values)
                if sum(map(len, out[0])) >= ROUND:
                    yield _pairs([langs[a].as_py()] * sum(map(len, out[0])), *out)
                    out = ([], [], [])
            if out[0]:
                yield _pairs([langs[a].as_py()] * sum(map(len, out[0])), *out)


def _baseline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group its row and its column of the sums that would hold if no term were shared."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("lang", "g", "z", "kept_terms", "v")}
            shares, numbers, zeros, kept = (np.array(batch.column(c)[i].values.to_numpy(zero_copy_only=False), np.int64) for c in ("shares", "numbers", "zeros", "kept"))
            along, down = np.zeros(len(zeros), np.int64), np.zeros(len(zeros), np.int64)
            if row["v"]:
                for p, n in zip(shares, numbers, strict=True):
                    along += n * _f(p, zeros)
                    down += n * _f(zeros, p)
                along += (row["v"] - row["kept_terms"] - kept) * _f(np.int64(row["z"]), zeros)
            peers = np.delete(np.arange(len(zeros)), row["g"])
            if len(peers):
                own = np.full(len(peers), row["g"])
                yield _pairs([row["lang"]] * (2 * len(peers)), [own, peers], [peers, own], [along[peers], down[peers]])


PAIRS = "lang string, g int, h int, value bigint"


def audit(docs: DataFrame) -> DataFrame:
    """The query's columns: pair rows and term rows of every group."""
    counts = stored(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term is not null").select(
        "lang", "source", "term", "n", F.sum("docs").over(of_term).alias("lang_docs"), F.sum("n").over(of_term).alias("lang_n"),
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("int").alias("new"),
    ).where(F.col("lang_docs") >= LEAST_DOCS)
    kept = stored(kept.drop("lang_docs"), "kept-terms")

    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("kept_terms"))
    langs = kept.groupBy("lang").agg(F.sum("new").alias("v"), F.sum("n").alias("lang_size"))
    in_lang = Window.partitionBy("lang")
    groups = counts.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = groups.withColumn("z", F.when(F.col("v") > 0, share(F.lit(0), F.col("size") + F.col("v"))).otherwise(0))
    groups = groups.withColumn("g", F.row_number().over(in_lang.orderBy("source")) - 1).withColumn("peers", F.count(F.lit(1)).over(in_lang))
    groups = stored(groups, "groups")

    postings = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "g", "z", "peers", share(F.col("n"), F.col("size") + F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_size") + F.col("v")).alias("q"),
    )
    return _pair_rows(postings, groups).unionByName(_term_rows(postings))


def _pair_rows(postings: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = postings.select("lang", "term", "g", "p", "z", "peers").repartition("lang", "term").sortWithinPartitions("lang", "term")
    corrections = blocks.mapInArrow(_corrections, PAIRS)

    of_lang = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("g", "z", "kept_terms"))).alias("all"))
    shares = postings.groupBy("lang", "g", "p").agg(F.count(F.lit(1)).alias("number"))
    shares = shares.groupBy("lang", "g").agg(F.collect_list(F.struct("p", "number")).alias("own"))
    rows = groups.select("lang", "g", "z", "kept_terms", "v").join(shares, ["lang", "g"], "left").join(of_lang, "lang")
    none = F.array().cast("array<bigint>")
    rows = rows.select(
        "lang", "g", "z", "kept_terms", "v", F.coalesce("own.p", none).alias("shares"), F.coalesce("own.number", none).alias("numbers"),
        F.col("all.z").alias("zeros"), F.col("all.kept_terms").alias("kept"),
    )
    sums = corrections.unionByName(rows.mapInArrow(_baseline, PAIRS)).groupBy("lang", "g", "h").agg(F.sum(F.col("value").cast("decimal(28,0)")).cast("bigint").alias("value"))

    names = groups.select("lang", "g", "source")
    peers = names.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    named = sums.join(names, ["lang", "g"]).join(peers, ["lang", "h"])
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))


def _term_rows(postings: DataFrame) -> DataFrame:
    above = postings.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP)
