"""Quality rules: gradient-boosted trees over document statistics, scored as flat numpy node arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import common

#: Labelled rows that the trees are fitted on, at most: those with the least hashes of their keys.
LABELLED_ROWS = 4000
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGITS = bytes(range(48, 58))

#: Statistics that the trees see, with the sign by which quality may follow each: -1 only falls, 0 free.
FEATURES = (
    ("log_words", 0),
    ("mean_word_chars", 0),
    ("symbols_per_word", -1),
    ("symbol_words", -1),
    ("dup_line_share", -1),
    ("repeat_word_share", -1),
    ("distinct_word_share", 0),
    ("upper_share", -1),
    ("digit_share", 0),
    ("shout_share", -1),
    ("sentence_share", 0),
    ("words_per_line", 0),
)


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a 3-word window found twice or more, and the number of distinct words."""
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    size = len(known)
    if n < 4:
        return 0, size
    if size < 1 << 21:
        codes = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # still exact: pairs are numbered before the third word joins
        pairs = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1]
        codes = pairs * size + ids[2:]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0, size
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum()), size


def statistics(text: str) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the values of FEATURES."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, bare = len(words), len(data.translate(None, SPACE))
    chars = len(text) - (len(data) - bare)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    repeat, distinct = repeated_words(words)
    upper, lower = bare - len(data.translate(None, UPPER + SPACE)), bare - len(data.translate(None, LOWER + SPACE))
    digits = bare - len(data.translate(None, DIGITS + SPACE))
    w, some = max(n, 1), max(chars, 1)
    values = [
        float(np.log1p(n)), chars / w, symbols / w, min(1.0, symbols / w), dup / max(len(lines), 1), repeat / w, distinct / w, upper / some, digits / some,
        upper / max(upper + lower, 1), (data.count(b".") + data.count(b"!") + data.count(b"?")) / w, n / max(len(lines), 1),
    ]
    return (n, chars, symbols, dup, repeat), values


@dataclass
class Trees:
    """Nodes of all trees in flat arrays; roots are where each tree starts; a leaf's children are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of rows: all rows go down one level of all trees at a time."""
        if not len(self.roots):
            return np.full(len(x), self.bias)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 20, ridge: float = 2.0) -> Trees:
    """Boosting of logistic loss on histograms. A split on a signed feature is taken only if its sides' values stand in that order, and bounds what lies below it at their middle."""
    n = len(y)
    mean = float(np.clip(y.mean(), 0.01, 0.99)) if n else 0.5
    bias = float(np.log(mean / (1 - mean)))
    nodes: list[list] = []
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
        margin = np.full(n, bias)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
            me = len(nodes)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            leaf = float(np.clip(-total_g / (total_h + ridge), low, high))
            nodes.append([0, np.inf, me, me, rate * leaf])
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for k, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, k]
                    sg = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                    sh = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                    sn = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                    a, z = np.clip(-sg / (sh + ridge), low, high), np.clip(-(total_g - sg) / (total_h - sh + ridge), low, high)
                    gain = sg**2 / (sh + ridge) + (total_g - sg) ** 2 / (total_h - sh + ridge) - total_g**2 / (total_h + ridge)
                    ok = (sn >= least) & (len(rows) - sn >= least) & (signs[k] * (z - a) >= 0)
                    gain = np.where(ok, gain, -1)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (gain[i], (k, i, float(a[i]), float(z[i])))
            if best[1]:
                k, i, a, z = best[1]
                middle = (a + z) / 2
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[k]]
                goes = binned[rows, k] <= i
                nodes[me][:2] = [k, float(cuts[k][i])]
                nodes[me][2] = grow(rows[goes], g, h, level + 1, *bounds[0])
                nodes[me][3] = grow(rows[~goes], g, h, level + 1, *bounds[1])
                nodes[me][4] = 0.0
            return me

        everything = np.arange(n)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(grow(everything, p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf))
            one = flat(nodes, roots[-1:], depth, 0.0)
            margin += one.margin(x)
    return flat(nodes, roots, depth, bias)


def flat(nodes: list[list], roots: list[int], depth: int, bias: float) -> Trees:
    a = list(zip(*nodes, strict=True)) or [()] * 5
    return Trees(np.array(a[0], np.int64), np.array(a[1], float), np.array(a[2], np.int64), np.array(a[3], np.int64), np.array(a[4], float), np.array(roots, np.int64), depth, bias)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def base_failed(base: tuple[int, ...]) -> bool:
    return base[0] < 50 or 100 * base[4] > 50 * base[0]


def fit_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = LABELLED_ROWS) -> Trees:
    """Trees fitted on at most `rows` labelled documents, those whose keys have the least hashes; without both labels, a constant."""
    common.prepare(df.sparkSession)
    key = F.xxhash64("doc_id")
    some = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(key, "doc_id").limit(rows)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = [statistics(t)[1] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    # Bounded by `rows`, so the labelled keys are sent to every task.
    drawn = common.keyed(df, id_col, text_col).join(F.broadcast(some), "doc_id").select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, x array<double>")
    got = drawn.orderBy(key, "doc_id", "x").limit(rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit_trees(x, (got["label"].to_numpy(float) > 0).astype(float), [s for _, s in FEATURES])


def judge(texts: list[str], trees: Trees, threshold: float) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray]:
    """Base statistics, base_failed, score and kept of texts."""
    found = [statistics(t) for t in texts]
    base = [b for b, _ in found]
    failed = np.array([base_failed(b) for b in base], bool)
    score = trees.score(np.array([v for _, v in found], float).reshape(-1, len(FEATURES)))
    return base, failed, score, ~failed & (score >= threshold)


def score_documents(df: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics and verdict of every whole text, a row per input row.

    doc_id, the five base statistics, base_failed (under 50 words, or over half of them in repeated windows), score (0 to
    1) and kept (not base_failed, and score at least threshold). A null text counts as empty: no words, base_failed, not
    kept. A null key stays null; repeated rows give a row each; an empty table gives none; other columns are left out.
    No shuffle; the trees go to the tasks with the code.
    """
    common.prepare(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            base, failed, score, kept = judge(batch.column(1).to_pylist(), trees, threshold)
            columns = [pa.array([b[k] for b in base], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(failed), pa.array(score), pa.array(kept)], ["doc_id", *BASE, "base_failed", "score", "kept"])

    return common.keyed(df, id_col, text_col).mapInArrow(run, SCHEMA + ", score double, kept boolean")


def keep_good(df: DataFrame, trees: Trees, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score_documents() would keep, with all their columns, whatever their names."""
    common.prepare(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = judge([t or "" for t in batch.column(at).to_pylist()], trees, threshold)[3]
            yield batch.filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
