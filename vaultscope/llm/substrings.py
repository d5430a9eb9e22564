"""Removal of long repeated passages by a compacted De Bruijn graph.

An edge of the graph is a run of ``size`` words, from the node of its first
``size - 1`` words to the node of its last ``size - 1``; an edge's successor in a
document is the run that starts one word later.

1. Equal word sequences become one document first, so copies add no edges.
2. Only edges that can repeat are made: each run has a minimizer (its short run of
   least hash), and an edge is made only where that is the minimizer of runs in two
   different sequences.  No repeated edge is missed; about one word in twenty is
   looked up instead of each.
3. Edges are pre-aggregated: the graph has the edges that occur in several documents,
   each with its source coordinate, its first place in the smallest doc_id.
4. Nodes are the runs of ``size - 1`` words at an edge's ends.  A node with one edge in and
   one out is not branching and links them (a join of edges on their nodes).  Links
   compact into paths: first those that also follow each other in one source, as runs of
   coordinates, then what joins such runs, as connected components.
5. Paths are mapped back to the documents: neighbouring occurrences on one path make a
   span, cut where the source coordinates don't go on side by side.
6. So every edge of a span was found equal (128 bits of hash) at its place in the
   document and at its place in the source, and the span is one run of words at both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .shared import components, table

_SEEDS = (0x2545F4914F6CDD1D, 0x6A09E667F3BCC909)


def _sliding(a: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` over each run of ``width`` values, from prefixes and suffixes of blocks of that width."""
    n = len(a)
    if n < width:
        return a[:0]
    padded = np.full(-(-n // width) * width, fill, a.dtype)
    padded[:n] = a
    cut = padded.reshape(-1, width)
    prefix = best.accumulate(cut, axis=1).ravel()
    suffix = best.accumulate(cut[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(suffix[: n - width + 1], prefix[width - 1 : n])


def minimizers(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The least short-run hash of each run of ``size`` words, and which runs lie inside one text."""
    short = max(1, size // 3)
    width = size - short + 1
    runs = tokens.windows(words, short)
    least = _sliding(runs, width, np.minimum, 2**64 - 1)
    whole = np.ones(len(least), bool)
    for start in first[1:-1]:
        whole[max(0, start - size + 1) : start] = False
    return least, whole


def _sequence(words: np.ndarray, seed: int) -> np.uint64:
    return tokens.windows(words, len(words), seed)[0] if len(words) else np.uint64(0)


def _marks(size: int):
    """Per row: number of words, hash of the word sequence, distinct minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in tokens.blocks(batch.column(1)):
                words, first = tokens.word_hashes(data, offsets)
                least, whole = minimizers(words, first, size)
                n = np.diff(first)
                new = whole.copy()
                new[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
                at = np.flatnonzero(new)
                cut = np.searchsorted(at, first)
                own = [np.unique(least[at[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
                lens = np.cumsum([0, *map(len, own)])
                parts = [words[a:b] for a, b in zip(first[:-1], first[1:])]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(row, len(n)),
                        "n_words": pa.array(n.astype(np.int64)),
                        **{f"s{k}": pa.array(np.array([_sequence(p, s) for p in parts], np.uint64).view(np.int64)) for k, s in enumerate(_SEEDS)},
                        "anchors": pa.ListArray.from_arrays(
                            pa.array(lens.astype(np.int32)), pa.array(tokens.signed(np.concatenate([*own, np.zeros(0, np.uint64)])))
                        ),
                    }
                )

    return run


def _edges(size: int):
    """(h0, h1, l, r, doc, text, pos) of the runs whose minimizers repeat: an edge's hashes, its
    nodes, and where it occurs (``text``: hash of the word sequence)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            hits = batch.column(2)
            for row, data, offsets in tokens.blocks(batch.column(1)):
                words, first = tokens.word_hashes(data, offsets)
                least, whole = minimizers(words, first, size)
                good = np.zeros(len(least), bool)
                for k, (a, b) in enumerate(zip(first[:-1], first[1:] - size + 1)):
                    if b > a:
                        good[a:b] = np.isin(tokens.signed(least[a:b]), hits[row + k].values.to_numpy())
                pos = np.flatnonzero(good & whole)
                if len(pos):
                    owner = np.searchsorted(first, pos, side="right") - 1
                    node = tokens.windows(words, size - 1) if size > 1 else np.zeros(len(words) + 1, np.uint64)
                    whole_text = np.array([_sequence(words[a:b], _SEEDS[0]) for a, b in zip(first[:-1], first[1:])], np.uint64)
                    yield pa.record_batch(
                        {
                            **{f"h{k}": pa.array(tokens.signed(tokens.windows(words, size, s)[pos])) for k, s in enumerate(_SEEDS)},
                            "l": pa.array(tokens.signed(node[pos])),
                            "r": pa.array(tokens.signed(node[pos + 1])),
                            "doc": pa.array(ids[row + owner]),
                            "text": pa.array(tokens.signed(whole_text[owner])),
                            "pos": pa.array((pos - first[owner]).astype(np.int32)),
                        }
                    )

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, words, removed = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            raw, spans = text.as_py() or b"", spans.as_py() or ()
            own = raw.split()
            gone = np.zeros(len(own), bool)
            if spans:
                data = np.frombuffer(raw, np.uint8)
                mark = int(tokens.signed(np.array([_sequence(tokens.word_hashes(data, np.array([0, len(data)]))[0], _SEEDS[0])]))[0])
            for span in spans:
                if span["text"] == mark:
                    gone[span["pos"] : span["pos"] + span["n"]] = True
            words.append(len(own))
            removed.append(int(gone.sum()))
            texts.append(b" ".join([w for w, g in zip(own, gone) if not g] if removed[-1] else own))
        yield pa.record_batch(
            [batch.column(0), pa.array(texts, pa.binary()), pa.array(words, pa.int64()), pa.array(removed, pa.int64())],
            names=["doc_id", "text", "n_words", "n_removed"],
        )


def compacted(edges: DataFrame) -> DataFrame:
    """Maximal nonbranching paths of a De Bruijn graph: source, source_pos, path, path_pos.

    ``edges`` (source, source_pos, l, r): distinct edges, named by their source coordinates, with
    their nodes.  A path is named by an edge of it; edges on no other's path are their own.
    """
    own = F.struct("source", "source_pos")
    into = edges.groupBy(F.col("r").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("a")).where("n = 1")
    out = edges.groupBy(F.col("l").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("b")).where("n = 1")
    links = table(into.select("node", "a").join(out.select("node", "b"), "node").where("a <> b").select("a", "b"))

    # links between neighbours in one source: a run starts where none comes in
    straight = (F.col("a.source") == F.col("b.source")) & (F.col("a.source_pos") + 1 == F.col("b.source_pos"))
    onward = links.where(straight).select(F.col("b.source").alias("source"), F.col("b.source_pos").alias("source_pos"), F.lit(True).alias("goes_on"))
    start = F.when(F.col("goes_on").isNull(), F.col("source_pos"))
    upto = Window.partitionBy("source").orderBy("source_pos").rowsBetween(Window.unboundedPreceding, 0)
    runs = edges.select("source", "source_pos").join(onward, ["source", "source_pos"], "left")
    runs = table(runs.withColumn("run_pos", F.max(start).over(upto)).select("source", "source_pos", "run_pos").withColumn("run", F.xxhash64("source", "run_pos")))

    # links that join runs
    of = lambda c: runs.select(F.struct("source", "source_pos").alias(c), F.col("run").alias(f"run_{c}"))
    between = links.where(~straight).join(of("a"), "a").join(of("b"), "b").select(F.col("run_a").alias("a"), F.col("run_b").alias("b"))
    label = components(between)
    return runs.join(label, F.col("run") == F.col("node"), "left").select("source", "source_pos", F.coalesce("component", "run").alias("path"))


def repeated_spans(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of words that also occur in a smaller doc_id: doc, text, pos, n, source, source_pos.

    Every run of ``size`` words that also starts in a smaller doc_id lies in a span
    of its document, and every span is covered by such runs.  Null ids and texts
    take no part.  Rows with the same doc_id are one document; ``text``, a hash of the
    word sequence, says which of its texts a span lies in.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts = texts.where("doc_id is not null")
    marks = table(texts.mapInArrow(_marks(size), "doc_id long, n_words long, s0 long, s1 long, anchors array<long>"))
    long = marks.where(F.col("n_words") >= size)
    first = table(long.groupBy("s0", "s1").agg(F.min("doc_id").alias("first")))
    long = long.join(first, ["s0", "s1"])
    copies = long.where("doc_id > first").select(
        F.col("doc_id").alias("doc"), F.col("s0").alias("text"), F.lit(0).alias("pos"), F.col("n_words").cast("int").alias("n"),
        F.col("first").alias("source"), F.lit(0).alias("source_pos"),
    )

    anchors = table(long.where("doc_id = first").select("doc_id", F.explode("anchors").alias("anchor")).distinct())
    twice = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    hits = table(anchors.join(twice.select("anchor"), "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("hits")))
    found = texts.join(hits.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "hits")
    edges = table(found.mapInArrow(_edges(size), "h0 long, h1 long, l long, r long, doc long, text long, pos int"))

    graph = edges.groupBy("h0", "h1").agg(F.min(F.struct("doc", "pos")).alias("s"), F.max("doc").alias("hi"), F.min("l").alias("l"), F.min("r").alias("r"))
    graph = table(graph.where("s.doc < hi").select("h0", "h1", "l", "r", F.col("s.doc").alias("source"), F.col("s.pos").alias("source_pos")))
    paths = compacted(graph.select("source", "source_pos", "l", "r"))
    # a table, so that Spark may split the occurrences of an edge that many documents hold
    placed = table(graph.join(paths, ["source", "source_pos"]).select("h0", "h1", "source", "source_pos", "path"))
    on_path = edges.join(placed, ["h0", "h1"]).where("doc > source")
    on_path = on_path.select("doc", "text", "pos", "path", "source", (F.col("pos") - F.col("source_pos")).alias("diagonal"))
    along = ["doc", "text", "path", "source", "diagonal"]
    step = Window.partitionBy(*along).orderBy("pos")
    spans = (
        on_path.repartition("doc").withColumn("run", F.col("pos") - F.dense_rank().over(step))
        .groupBy(*along, "run").agg(F.min("pos").alias("pos"), F.max("pos").alias("last"))
        .select("doc", "text", "pos", (F.col("last") - F.col("pos") + size).alias("n"), "source", (F.col("pos") - F.col("diagonal")).alias("source_pos"))
    )
    return copies.union(spans)


def remove_repeats(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes every word covered by a run of ``size`` words that also starts in a smaller doc_id.

    Words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` of the whole text,
    unchanged; runs are judged on the input and lie within one document.  Returns
    one row per input row: doc_id, text (the words that stay, joined by one space),
    n_words (before) and n_removed.  A null text has no words.  A row with a null
    doc_id keeps its words and takes none from others.  Rows with the same doc_id
    don't remove each other's words, and each loses its own repeats only.  Other columns are ignored; an empty table
    gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    spans = repeated_spans(docs, size, id_col, text_col).groupBy("doc").agg(F.collect_set(F.struct("text", "pos", "n")).alias("spans"))
    return (
        texts.join(table(spans).hint("shuffle_hash"), F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "spans")
        .mapInArrow(_removed, "doc_id long, text binary, n_words long, n_removed long")
    )
