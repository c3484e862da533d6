"""Table metrics against ground truth: tree-edit similarity, grid similarity, averages."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.html_tables import Tree, cells, tree


def edit_distance(a: str, b: str) -> int:
    """Rows of the table at once: an insertion is the running least of what is left of it."""
    if a == b or not a or not b:
        return 0 if a == b else max(len(a), len(b))
    other = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = np.arange(len(b) + 1)
    row = places.copy()
    for i, x in enumerate(a, 1):
        above = row[1:] + 1
        through = row[:-1] + (other != ord(x))
        row = np.concatenate(([i], np.minimum(above, through)))
        row = np.minimum.accumulate(row - places) + places
    return int(row[-1])


def rename_cost(a: Tree, b: Tree, structure_only: bool) -> float:
    if a.tag != b.tag or a.spans != b.spans:
        return 1.0
    longest = max(len(a.text), len(b.text))
    if structure_only or a.spans is None or not longest:
        return 0.0
    return edit_distance(a.text, b.text) / longest


def _postorder(t: Tree) -> tuple[list[Tree], list[int], list[int]]:
    """Nodes in postorder, the leftmost leaf of each, and the key roots."""
    nodes: list[Tree] = []
    left: list[int] = []
    todo: list[tuple[Tree, int]] = [(t, -1)]  # a node, and how many nodes came before it once it is entered
    while todo:
        at, before = todo.pop()
        if before < 0:
            todo.append((at, len(nodes)))
            todo += [(c, -1) for c in reversed(at.children)]
        else:
            left.append(left[before] if at.children else len(nodes))
            nodes.append(at)
    roots = sorted({leaf: i for i, leaf in enumerate(left)}.values())
    return nodes, left, roots


def tree_distance(a: Tree, b: Tree, structure_only: bool = False) -> float:
    """The least cost of inserting, deleting (1 each) and renaming nodes: dynamic programming over key roots."""
    na, la, ra = _postorder(a)
    nb, lb, rb = _postorder(b)
    known: dict[tuple, float] = {}

    def renamed(x: Tree, y: Tree) -> float:
        key = (x.tag, x.spans, x.text, y.tag, y.spans, y.text)
        if key not in known:
            known[key] = rename_cost(x, y, structure_only)
        return known[key]

    cost = [[renamed(x, y) for y in nb] for x in na]
    dist = [[0.0] * len(nb) for _ in na]
    for i in ra:
        for j in rb:
            first, other = la[i], lb[j]
            above = [float(y) for y in range(j - other + 2)]
            part = [above]
            for p in range(first, i + 1):
                row = [above[0] + 1]
                whole_a, before, own, price = la[p] == first, part[la[p] - first], dist[p], cost[p]
                for q in range(other, j + 1):
                    y = q - other + 1
                    best = min(above[y], row[y - 1]) + 1
                    if whole_a and lb[q] == other:
                        best = own[q] = min(best, above[y - 1] + price[q])
                    else:
                        best = min(best, before[lb[q] - other] + own[q])
                    row.append(best)
                part.append(row)
                above = row
    return dist[-1][-1]


def _size(t: Tree) -> int:
    n, todo = 0, [t]
    while todo:
        at = todo.pop()
        n += 1
        todo += at.children
    return n


def teds(truth: str, prediction: str, structure_only: bool = False) -> float:
    return _teds(tree(truth), tree(prediction), structure_only)


def _teds(a: Tree, b: Tree, structure_only: bool) -> float:
    return max(0.0, 1.0 - tree_distance(a, b, structure_only) / max(_size(a), _size(b)))


MOST_TREES, MOST_ROWS, LONGEST_ROW, MOST_RENAMED, MOST_CELLS = 1024, 10_000, 2000, 200_000, 2_000_000
_ROW = re.compile(r'<tr>(?:<(td|th)(?: rowspan="[0-9]+" colspan="[0-9]+")?>[^<]*</\1>)*')


class _Scores:
    """Tree-edit similarities of many pairs of tables, those of like shape at once.

    Equal subtrees get one number, and the distance of two subtrees is worked out once for all pairs that hold them.
    Both roots are tables, which costs nothing to rename, so some best edit maps root to root: an edit that maps one of
    them elsewhere, or neither, costs no more with the two mapped to each other instead. What is left is the distance of
    the forests below. Its recurrence needs the distances of subtrees only; pairs of forests of like shape take the same
    steps, so each step is taken for all of them as one array. What is known is dropped when it is more than MOST_TREES
    subtrees; a pair with more new ones than that is worked out on its own.
    """

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.nodes: list[Tree] = []
        self.post: list[tuple[int, ...]] = []  # the numbers of a subtree's nodes, in postorder
        self.left: list[tuple[int, ...]] = []  # the place of the leftmost leaf of each
        self.rows: dict[str, tuple | None] = {}
        self.dist = np.full((64, 64), np.nan)
        self.renamed: dict[tuple[int, int], float] = {}
        self.bare: dict[tuple, float] = {}

    def _numbered(self, root: Tree, texts: bool) -> tuple[int, ...]:
        """The numbers of the subtrees below a root, with or without their texts."""
        nodes, left, _ = _postorder(root)
        own: list[int] = []
        for i, (node, leaf) in enumerate(zip(nodes[:-1], left[:-1], strict=True)):
            label = (node.tag, node.spans, node.text if texts else "")
            key = (label, tuple(own[leaf:i]), tuple(x - leaf for x in left[leaf : i + 1]))
            at = self.number.setdefault(key, len(self.nodes))
            if at == len(self.nodes):
                self.nodes.append(Tree(*label, []))
                self.post.append((*own[leaf:i], at))
                self.left.append(key[2])
            own.append(at)
        top, i = [], len(nodes) - 2
        while i >= 0:
            top.append(own[i])
            i = left[i] - 1
        return tuple(reversed(top))

    def _row(self, source: str) -> tuple | None:
        """The numbers of a row with and without texts; None if it is not one that reads alike wherever it stands."""
        try:
            root = tree(f"<table>{source}</tr></table>") if _ROW.fullmatch(source) else None
        except ValueError:
            root = None
        return root and (self._numbered(root, True), self._numbered(root, False))

    def _read(self, html: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The forests of a table with and without texts. Rows without markup in their cells are read once."""
        if html.startswith("<table><tr>") and html.endswith("</tr></table>"):
            full: tuple[int, ...] = ()
            bare: tuple[int, ...] = ()
            for source in html[7:-13].split("</tr>"):
                if source not in self.rows and len(source) <= LONGEST_ROW:
                    self.rows[source] = self._row(source)
                known = self.rows.get(source)
                if known is None:
                    break
                full += known[0]
                bare += known[1]
            else:
                return full, bare
        root = tree(html)
        return self._numbered(root, True), self._numbered(root, False)

    def _rename(self, x: int, y: int) -> float:
        if (x, y) not in self.renamed:
            self.renamed[x, y] = rename_cost(self.nodes[x], self.nodes[y], False)
        return self.renamed[x, y]

    def _subtrees(self, x: int, y: int) -> float:
        """The distance of two subtrees; those of all smaller ones within them are known."""
        px, py = self.post[x], self.post[y]
        if len(px) == 1 or len(py) == 1:
            return max(len(px), len(py)) - 1 + min(self._rename(i, j) for i in px for j in py)
        lx, ly = self.left[x], self.left[y]
        known = self.dist[np.ix_(px, py)].tolist()
        rows = [[float(j) for j in range(len(py) + 1)]]
        for i, own in enumerate(known):
            above, before = rows[-1], rows[lx[i]]
            row = [i + 1.0]
            for j, d in enumerate(own):
                through = above[j] + self._rename(x, y) if i == len(px) - 1 and j == len(py) - 1 else before[ly[j]] + d
                row.append(min(above[j + 1] + 1, row[j] + 1, through))
            rows.append(row)
        return rows[-1][-1]

    def _learn(self, a: np.ndarray, b: np.ndarray) -> None:
        """The distances of all subtrees of the forests a and of b, row by row."""
        n = 1 + int(max(a.max(), b.max()))
        if n > len(self.dist):
            wider = np.full((size := max(n, min(2 * n, 2 * MOST_TREES)), size), np.nan)
            wider[: len(self.dist), : len(self.dist)] = self.dist
            self.dist = wider
        if len(self.renamed) > MOST_RENAMED:
            self.renamed = {}
        new: set[int] = set()
        for own in a.T:
            at = np.isnan(self.dist[own[:, None], b])
            if at.any():
                new.update((own[:, None] * n + b)[at].tolist())
        for x, y in sorted((divmod(k, n) for k in new), key=lambda k: len(self.post[k[0]]) + len(self.post[k[1]])):
            self.dist[x, y] = self._subtrees(x, y)

    def _lefts(self, forest: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for t in forest:
            begin = len(out)
            out += [begin + x for x in self.left[t]]
        return out

    def _distances(self, pairs: list[tuple]) -> list[float]:
        alike: dict[tuple, list[int]] = {}
        for i, (a, b) in enumerate(pairs):
            alike.setdefault((tuple([self.left[t] for t in a]), tuple([self.left[t] for t in b])), []).append(i)
        out = [0.0] * len(pairs)
        for of in alike.values():
            la, lb = (self._lefts(x) for x in pairs[of[0]])
            if not la or not lb:
                for i in of:
                    out[i] = float(len(la) + len(lb))
                continue
            lot = max(1, MOST_CELLS // (len(la) * len(lb)))
            for first in range(0, len(of), lot):
                own = of[first : first + lot]
                a, b = (np.array([[n for t in pairs[i][side] for n in self.post[t]] for i in own]) for side in (0, 1))
                self._learn(a, b)
                for i, d in zip(own, self._forests(a, b, la, lb), strict=True):
                    out[i] = d
        return out

    def _forests(self, a: np.ndarray, b: np.ndarray, la: list[int], lb: list[int]) -> list[float]:
        rows = [np.repeat(np.arange(len(lb) + 1.0)[:, None], len(a), 1)]
        before_b = np.array(lb)
        for i, leaf in enumerate(la):
            best = np.minimum(rows[leaf][before_b] + self.dist[a[:, i], b.T], rows[-1][1:] + 1)
            row = np.empty_like(rows[0])
            row[0] = i + 1
            for j in range(len(lb)):
                np.add(row[j], 1, out=row[j + 1])
                np.minimum(row[j + 1], best[j], out=row[j + 1])
            rows.append(row)
        return rows[-1][-1].tolist()

    def _settle(self, found: list[tuple | None], out: list[tuple]) -> None:
        """Scores of the pairs read so far, each pair of forests once."""
        size = lambda forest: 1 + sum(len(self.post[t]) for t in forest)
        score = lambda pairs: {k: max(0.0, 1.0 - d / max(size(k[0]), size(k[1]))) for k, d in zip(pairs, self._distances(pairs), strict=True)}
        full = score(list(dict.fromkeys(x[0] for x in found if x and x[0])))
        self.bare |= score(list(dict.fromkeys(x[1] for x in found if x and x[0] and x[1] not in self.bare)))
        out += [(None, None) if x is None else (full[x[0]], self.bare[x[1]]) if x[0] else x[1] for x in found]
        if len(self.bare) > MOST_ROWS:
            self.bare = {}

    def __call__(self, pairs: Iterable[tuple[str | None, str | None]]) -> list[tuple]:
        """(teds, teds_s) of each pair; nulls where a side has no table."""
        found: list[tuple | None] = []  # forests with and without texts; nothing and the scores of a pair too large for this
        out: list[tuple] = []
        for x, y in pairs:
            if len(self.nodes) > MOST_TREES or len(self.rows) > MOST_ROWS:
                self._settle(found, out)
                found = []
                self._forget()
            had = len(self.nodes)
            try:
                a, b = self._read(x or ""), self._read(y or "")
            except ValueError:
                found.append(None)
                continue
            if len(self.nodes) - had <= MOST_TREES:
                found.append(((a[0], b[0]), (a[1], b[1])))
                continue
            self._settle(found, out)
            found = []
            self._forget()
            one, other = tree(x), tree(y)
            found.append(((), (_teds(one, other, False), _teds(one, other, True))))
        self._settle(found, out)
        return out


def _spread(pairs: DataFrame) -> DataFrame:
    """Rows dealt to all tasks: they are few bytes and much work, so partitions are not to be put together by size."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def teds_scores(pairs: DataFrame, truth: str = "gt_html", prediction: str = "pred_html") -> DataFrame:
    """pairs with teds and teds_s; null where a side has no table."""

    @F.pandas_udf(T.StructType([T.StructField("teds", T.DoubleType()), T.StructField("teds_s", T.DoubleType())]))
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        scores = _Scores()
        for a, b in batches:
            yield pd.DataFrame(scores(zip(a, b, strict=True)), columns=["teds", "teds_s"])

    return _spread(pairs).withColumn("s", score(truth, prediction)).select(*pairs.columns, "s.teds", "s.teds_s")


def _grid(found: list[tuple]) -> list[list[tuple]]:
    """(offset in the cell and span, text) of every position; empty positions are cells of their own."""
    rows = max((c[0] + c[2] for c in found), default=0)
    cols = max((c[1] + c[3] for c in found), default=0)
    grid = [[((0, 0, 1, 1), "") for _ in range(cols)] for _ in range(rows)]
    for r, c, high, wide, text, _ in found:
        for i in range(high):
            for j in range(wide):
                grid[r + i][c + j] = ((-j, -i, wide - j, high - i), text)
    return grid


def _box_iou(a: tuple, b: tuple) -> float:
    wide, high = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0, wide) * max(0, high)
    whole = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / whole if whole else 0.0


def _common(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b))


def _align(n: int, m: int, reward) -> tuple[float, list[tuple[int, int]]]:
    gain = [[reward(i, j) for j in range(m)] for i in range(n)]
    best = [[0.0] * (m + 1)]
    for own in gain:
        above, row = best[-1], [0.0]
        for j in range(m):
            row.append(max(above[j + 1], row[j], above[j] + own[j]))
        best.append(row)
    pairs, i, j = [], n, m
    while i and j:
        if best[i][j] == best[i - 1][j - 1] + gain[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m], pairs[::-1]


def _alignment(a: list[list], b: list[list], alike) -> float:
    """Rows are aligned by the best alignment of their cells, columns likewise; the score counts the cells of both."""
    memo: dict = {}

    def near(x: tuple, y: tuple) -> float:
        if (x, y) not in memo:
            memo[x, y] = alike(x, y)
        return memo[x, y]

    row_pairs = _align(len(a), len(b), lambda i, j: _align(len(a[0]), len(b[0]), lambda p, q: near(a[i][p], b[j][q]))[0])[1]
    col_pairs = _align(len(a[0]), len(b[0]), lambda p, q: _align(len(a), len(b), lambda i, j: near(a[i][p], b[j][q]))[0])[1]
    total = sum(near(a[i][p], b[j][q]) for i, j in row_pairs for p, q in col_pairs)
    return 2 * total / (len(a) * len(a[0]) + len(b) * len(b[0]))


def grid_similarity(truth: str, prediction: str) -> tuple[float, float]:
    """GriTS for topology and content, by the factored alignment of the published method."""
    a, b = _grid(cells(truth)), _grid(cells(prediction))
    if not a or not b or not a[0] or not b[0]:
        return 0.0, 0.0
    return _alignment(a, b, lambda x, y: _box_iou(x[0], y[0])), _alignment(a, b, lambda x, y: _common(x[1], y[1]))


def _shared(a: tuple | None, b: tuple | None) -> float:
    """The common area of two boxes over that of the box around both."""
    if a is None or b is None:
        return 0.0
    both = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
    around = (max(a[2], b[2]) - min(a[0], b[0])) * (max(a[3], b[3]) - min(a[1], b[1]))
    return both / around if around > 0 else 0.0


def grid_location(truth: list[tuple], prediction: list[tuple]) -> float | None:
    """GriTS for location. Cells are (row, col, rowspan, colspan, box); None unless both sides have cells, all with boxes."""
    if not truth or not prediction or any(c[4] is None for c in [*truth, *prediction]):
        return None
    grids = []
    for found in (truth, prediction):
        grid: list[list] = [[None] * max(c[1] + c[3] for c in found) for _ in range(max(c[0] + c[2] for c in found))]
        for r, c, high, wide, place in found:
            for i in range(r, r + high):
                grid[i][c : c + wide] = [tuple(place)] * wide
        grids.append(grid)
    return _alignment(*grids, _shared)


def grits_loc_scores(pairs: DataFrame, truth: str = "gt_cells", prediction: str = "pred_cells") -> DataFrame:
    """pairs with grits_loc; truth and prediction are arrays of cells (row, col, rowspan, colspan, box)."""

    @F.udf(T.DoubleType())
    def score(a, b):
        own = [[(c["row"], c["col"], c["rowspan"], c["colspan"], c["box"]) for c in x or ()] for x in (a, b)]
        return grid_location(*own)

    return pairs.withColumn("grits_loc", score(truth, prediction))


def grits_scores(pairs: DataFrame, truth: str = "gt_html", prediction: str = "pred_html") -> DataFrame:
    @F.pandas_udf(T.StructType([T.StructField("grits_top", T.DoubleType()), T.StructField("grits_con", T.DoubleType())]))
    def score(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(a, b, strict=True):
            try:
                out.append(grid_similarity(x or "", y or ""))
            except ValueError:
                out.append((None, None))
        return pd.DataFrame(out, columns=["grits_top", "grits_con"])

    return _spread(pairs).withColumn("s", score(truth, prediction)).select(*pairs.columns, "s.grits_top", "s.grits_con")


FIELDS = ("teds", "teds_s", "grits_top", "grits_con", "grits_loc")


def metric_rows(matches: DataFrame, scores: DataFrame) -> DataFrame:
    """matches: gt_id, pred_id, gt_has_cells; scores: gt_id and FIELDS of the matched. A missed table scores 0."""
    both = matches.where("gt_id is not null").join(scores, "gt_id", "left")
    missed = F.col("pred_id").isNull()
    zero = {f: F.when(missed, F.lit(0.0)).otherwise(F.col(f)) for f in FIELDS[:-1]}
    zero["grits_loc"] = F.when(missed, F.when(F.col("gt_has_cells"), F.lit(0.0))).otherwise(F.col("grits_loc"))
    return both.select("gt_id", "pred_id", *(v.alias(k) for k, v in zero.items()), F.when(missed, "missed").otherwise("matched").alias("status"))


#: what readers of an evaluation should know
NOTES = ("The structural tree score leaves the text of cells out.", "The location score needs boxes of all cells on both sides.")


def evaluation_rows(matches: DataFrame, scores: DataFrame) -> DataFrame:
    """metric_rows, and a row without scores for each prediction that no truth took (status false_positive)."""
    wrong = matches.where("gt_id is null").select("gt_id", "pred_id", *(F.lit(None).cast("double").alias(f) for f in FIELDS), F.lit("false_positive").alias("status"))
    return metric_rows(matches, scores).unionByName(wrong)


def evaluation_summary(documents: DataFrame, rows: DataFrame, key: str = "doc") -> DataFrame:
    """One row per document: status (computed, or not_computed without ground truth), truths, matched, missed and false
    positives, the mean of each metric over the rows that have it, notes. Agreement of models is no accuracy, so
    nothing is computed without truths.

    documents: key; rows: key and evaluation_rows' columns.
    """
    n = lambda status: F.sum((F.col("status") == status).cast("long"))
    own = rows.groupBy(key).agg(n("matched").alias("matched"), n("missed").alias("missed"), n("false_positive").alias("false_positives"), *(F.avg(f).alias(f) for f in FIELDS))
    both = documents.select(key).distinct().join(own, key, "left").fillna(0, ["matched", "missed", "false_positives"])
    truths = F.col("matched") + F.col("missed")
    some = truths > 0
    return both.select(
        key, F.when(some, "computed").otherwise("not_computed").alias("status"), truths.alias("truths"), "matched", "missed", F.when(some, F.col("false_positives")).otherwise(0).alias("false_positives"),
        *(F.when(some, F.col(f)).alias(f) for f in FIELDS), F.when(some, F.array(*map(F.lit, NOTES))).otherwise(F.array(F.lit("no ground truth was given"))).alias("notes"),
    )


def metric_aggregate(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """metric, mean (over rows that have it, null if none), n. One pass, then one row per metric."""
    one = rows.agg(*[a for f in fields for a in (F.avg(f).alias(f"{f}_mean"), F.count(f).alias(f"{f}_n"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("metric"), F.col(f"{f}_mean").alias("mean"), F.col(f"{f}_n").alias("n")) for f in fields])))
