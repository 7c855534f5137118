"""Spelling variants: words one edit apart, by k-d trees over their letter counts.

One replaced letter lowers one count of the word's letter-count vector by 1 and raises another
by 1 (L1 distance 2); one inserted letter raises one count by 1 (L1 distance 1).  So for each pair
of equal lengths, and of lengths l and l + 1, the near words of a word are found by a range search
of a k-d tree over the count vectors of the other length; a subtree is pruned when its box cannot be
reached by the one rise (and, for equal lengths, the one fall) that the edit allows.  Candidates
are then verified letter by letter.

The search is spread over the cluster in two levels.  The upper levels of each length's tree are
cut from a sample on the driver (about ``SAMPLE`` words a cell, so it grows with the number of
cells; lengths with fewer words than a cell holds need none).  They only deal out rows: each word
goes to the cell of its vector, and as a query to the cells that its range reaches.  Every cell
then builds the rest of its tree over its own words.  Cells that hold more than ``limit`` words all
the same (words of equal counts cannot be parted by any plane) are cut by hash into parts of their
words and parts of their queries, which meet pair by pair: memory stays bounded and nothing is lost.

Words: maximal runs of letters (A-Z, a-z, code points 0xC0 to 0xFF), only A-Z lower-cased.  A null
or empty text has none; a text of any length is cut whole; repeated rows count again; an empty table
gives no rows; other columns are not read.  Ties of a form go to the smallest word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.llm.common import cut, partitions_of
from episcope.operators.joins import bounded_broadcast

CELL_WORDS = 16_000      # words that a cell of the upper tree is meant to hold
SAMPLE = 24              # sampled words a cell
BUCKET = 96              # words in a leaf of a cell's own tree
COMPARED = 1 << 18       # pairs in one comparison of queries with a leaf
LETTERS = 26 + 64
LONGEST_CHAIN = 32       # forms grow tenfold at every step, so 19 steps exhaust a 64-bit count
POINT, SAME, LONGER = 0, 1, 2     # a row's role in a cell: a word of it, a query for words as long or one letter longer


def words_of(docs: DataFrame, text: str = "text", least: int = 7) -> DataFrame:
    """``docs`` exploded: one row (``run``) for each run of at least ``least`` letters."""
    low = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.withColumn("run", F.explode(F.regexp_extract_all(low, F.lit(r"([a-zÀ-ÿ]{%d,}+)" % least), F.lit(1))))


def vocabulary(words: DataFrame, least: int = 7, count: int = 2) -> DataFrame:
    """(word, n): distinct words of at least ``least`` code points and ``count`` occurrences."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


# ---------------------------------------------------------------- vectors and trees

def code_points(words: list[str], length: int) -> np.ndarray:
    """One row of code points for each of equally long words."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(-1, length)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """Letter-count vectors of words given by their code points."""
    rows, length = points.shape
    letter = np.where(points < 0xC0, points - ord("a"), points - 0xC0 + 26).astype(np.int64)
    flat = np.bincount((np.arange(rows)[:, None] * LETTERS + letter).ravel(), minlength=rows * LETTERS)
    return flat.reshape(rows, LETTERS).astype(np.int32)


def best_plane(vectors: np.ndarray):
    """(dimension, value): the plane "count <= value" that parts the vectors most evenly, or None."""
    n, best = len(vectors), (0, 0, 0)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    for dim in np.flatnonzero(low < high):
        below = np.cumsum(np.bincount(vectors[:, dim]))[:-1]
        even = np.minimum(below, n - below)
        value = int(even.argmax())
        if even[value] > best[0]:
            best = int(even[value]), int(dim), value
    return best[1:] if best[0] else None


def upper_tree(vectors: np.ndarray, cells: int) -> list:
    """Nodes (dimension, value, left, right), or (-1, cell, 0, 0) for a cell, root first, over a
    sample; a node is parted until it has about the share of one cell."""
    nodes: list = [None]
    waiting, made = [(0, vectors)], 0
    while waiting:
        at, own = waiting.pop()
        plane = best_plane(own) if len(own) * cells >= 1.5 * len(vectors) and len(own) > 1 else None
        if plane is None:
            nodes[at] = (-1, made, 0, 0)
            made += 1
        else:
            left = own[:, plane[0]] <= plane[1]
            nodes[at] = (*plane, len(nodes), len(nodes) + 1)
            waiting += [(len(nodes), own[left]), (len(nodes) + 1, own[~left])]
            nodes += [None, None]
    return nodes


def reached(value: np.ndarray, plane: int, rise: np.ndarray, fall: np.ndarray):
    """Of queries with these counts and rises and falls still free, those that reach the side
    "<= plane" and the other one, as (mask, rise left, fall left) each."""
    down, up = np.maximum(value - plane, 0), np.maximum(plane + 1 - value, 0)
    return (down <= fall, rise, fall - down), (up <= rise, rise - up, fall)


def cells_of(nodes: list | None, vectors: np.ndarray, rise: int, fall: int):
    """(row, cell) of every cell that a row's range reaches (its own one, if the range is nil)."""
    rows = np.arange(len(vectors))
    if nodes is None:
        return rows, np.zeros(len(vectors), dtype=np.int64)
    out_row, out_cell = [], []
    stack = [(0, rows, np.full(len(rows), rise), np.full(len(rows), fall))]
    while stack:
        at, own, r, f = stack.pop()
        dim, value, left, right = nodes[at]
        if dim < 0:
            out_row.append(own)
            out_cell.append(np.full(len(own), value))
            continue
        for child, (ok, r2, f2) in zip((left, right), reached(vectors[own, dim], value, r, f)):
            if ok.any():
                stack.append((child, own[ok], r2[ok], f2[ok]))
    return np.concatenate(out_row), np.concatenate(out_cell)


def range_search(points: np.ndarray, queries: np.ndarray, rise: int, fall: int):
    """(point, query) index pairs whose vectors differ by exactly ``rise`` rises and ``fall`` falls
    of 1, searched through a k-d tree over the points.  Between words of these lengths that is a
    squared distance of rise + fall, which a leaf takes from one product of its vectors with those
    of the queries that reach it (small whole numbers, exact in floating point)."""
    used = (points.max(axis=0) > 0) | (queries.max(axis=0) > 0)
    points, queries = points[:, used], queries[:, used]
    kind = np.float32 if points.sum(axis=1).max() < 2000 else np.float64
    p_real, q_real = points.astype(kind), queries.astype(kind)
    p_square, q_square = (p_real * p_real).sum(axis=1), (q_real * q_real).sum(axis=1) - (rise + fall)
    stack = [(np.arange(len(points)), np.arange(len(queries)), np.full(len(queries), rise, dtype=np.int8), np.full(len(queries), fall, dtype=np.int8))]
    while stack:
        p, q, r, f = stack.pop()
        plane = best_plane(points[p]) if len(p) > BUCKET else None
        if plane is None:
            for i in range(0, len(p), 4 * BUCKET):
                some = p[i:i + 4 * BUCKET]
                for j in range(0, len(q), COMPARED // len(some)):
                    part = q[j:j + COMPARED // len(some)]
                    a, b = np.nonzero(2 * (q_real[part] @ p_real[some].T) == q_square[part][:, None] + p_square[some])
                    yield some[b], part[a]
            continue
        dim, value = plane
        left = points[p, dim] <= value
        for own, (ok, r2, f2) in zip((p[left], p[~left]), reached(queries[q, dim], value, r, f)):
            ok = np.flatnonzero(ok)
            if len(ok):
                stack.append((own, q[ok], r2[ok], f2[ok]))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of equally long words differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of ``long`` are those of ``short`` with one letter more."""
    head = np.cumprod(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= short.shape[1]


# ---------------------------------------------------------------- the search on the cluster

ROUTED = "size int, cell int, role int, word string, n long"
NEAR = "word string, near string, near_n long"


def _route(trees: dict[int, list]):
    def run(batches):
        for b in batches:
            words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own = [words[i] for i in at]
                vectors = letter_counts(code_points(own, size))
                for role, target, rise, fall in ((POINT, size, 0, 0), (SAME, size, 1, 1), (LONGER, size + 1, 1, 0)):
                    row, cell = cells_of(trees.get(int(target)), vectors, rise, fall)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), target), pa.int32()), pa.array(cell, pa.int32()), pa.array(np.full(len(row), role), pa.int32()),
                         pa.array([own[i] for i in row], pa.string()), pa.array(n[at[row]], pa.int64())], names=["size", "cell", "role", "word", "n"])
    return run


def _search(cell: pa.Table) -> pa.Table:
    """Near pairs of one cell: from each query to its near words, and for longer words back as well."""
    out = []
    role, n = cell["role"].to_numpy(), cell["n"].to_numpy()
    word = np.array(cell["word"].to_pylist(), dtype=object)
    of_cell = np.flatnonzero(role == POINT)
    if len(of_cell):
        size = len(word[of_cell[0]])
        points = code_points(list(word[of_cell]), size)
        vectors = letter_counts(points)
        for kind, length, fall, verified in ((SAME, size, 1, one_replaced), (LONGER, size - 1, 0, one_inserted)):
            asked = np.flatnonzero(role == kind)
            if not len(asked):
                continue
            queries = code_points(list(word[asked]), length)
            for p, q in range_search(vectors, letter_counts(queries), 1, fall):
                ok = verified(queries[q], points[p])
                a, b = asked[q[ok]], of_cell[p[ok]]
                out.append((a, b))
                if kind == LONGER:
                    out.append((b, a))
    a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 2
    return pa.table({"word": pa.array(word[a], pa.string()), "near": pa.array(word[b], pa.string()), "near_n": pa.array(n[b], pa.int64())})


def _trees(vocab: DataFrame, cell_words: int) -> dict[int, list]:
    """Upper tree of each length that has more words than a cell is meant to hold."""
    counts = vocab.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_words).collect()
    cells = {r["size"]: -(-r["n"] // cell_words) for r in counts}
    if not cells:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["size"], int(min(1.0, SAMPLE * cells[r["size"]] / r["n"]) * (1 << 30)))])[F.length("word")]
    sample = vocab.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share).select("word").collect()
    by_size: dict[int, list[str]] = {}
    for r in sorted(x["word"] for x in sample):
        by_size.setdefault(len(r), []).append(r)
    return {size: upper_tree(letter_counts(code_points(words, size)), cells[size]) for size, words in by_size.items()}


def near_pairs(vocab: DataFrame, cell_words: int = CELL_WORDS, limit: int | None = None) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words of ``vocab`` (word, n; distinct) one edit apart."""
    limit = limit or 4 * cell_words
    spark = vocab.sparkSession
    routed = cut(vocab.mapInArrow(_route(_trees(vocab, cell_words)), ROUTED), "routed")
    sizes = routed.groupBy(F.col("size").alias("_size"), F.col("cell").alias("_cell")).agg(
        F.ceil(F.count(F.when(F.col("role") == POINT, 1)) / limit).cast("int").alias("_p"),
        F.ceil(F.count(F.when(F.col("role") != POINT, 1)) / (16 * limit)).cast("int").alias("_q"))
    large = cut(sizes.filter("_p > 1 or _q > 1"), "large")
    rows = routed.withColumn("x", F.lit(0)).withColumn("y", F.lit(0))
    if not large.isEmpty():
        # a word is in one part of its cell's words and meets every part of the queries; a query the other way round
        p, q = F.greatest(F.coalesce("_p", F.lit(1)), F.lit(1)), F.greatest(F.coalesce("_q", F.lit(1)), F.lit(1))
        mine = F.col("role") == POINT
        rows = routed.join(bounded_broadcast(large), (F.col("size") == F.col("_size")) & (F.col("cell") == F.col("_cell")), "left") \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(mine, q).otherwise(p) - 1))) \
            .withColumn("x", F.when(mine, F.pmod(F.xxhash64("word"), p)).otherwise(F.col("other")).cast("int")) \
            .withColumn("y", F.when(mine, F.col("other")).otherwise(F.pmod(F.xxhash64("word"), q)).cast("int"))
    return rows.repartition(partitions_of(spark), "size", "cell", "x", "y").groupBy("size", "cell", "x", "y").applyInArrow(_search, NEAR)


def variants(vocab: DataFrame, times: int = 10, cell_words: int = CELL_WORDS, limit: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocab`` (word, n).

    A word's form is its near word of largest n (ties: the smallest word), if that n is at least
    ``times`` its own; its root is the last word that the forms lead to."""
    vocab = cut(vocab, "vocabulary")
    best = cut(near_pairs(vocab, cell_words, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")), "near") \
        .select(F.col("word").alias("_word"), "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    found = vocab.join(best, F.col("word") == F.col("_word"), "left").drop("_word")
    has = F.col("near_n") >= F.lit(times) * F.col("n")
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                             F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "forms")

    # pointer doubling: after k rounds a word's root is 2 ** k forms away, or the last one
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    hops = 1
    while hops < LONGEST_CHAIN:
        further = roots.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = cut(roots.join(further, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"), "roots")
        roots = step.drop("_next")
        if step.filter("_next is not null").isEmpty():
            break
        hops *= 2
    return found.join(roots.select(F.col("word").alias("_word"), "root"), F.col("word") == F.col("_word"), "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
