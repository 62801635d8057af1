"""Autoencoders per key: a small net per key, trained on a bounded sample of its rows, whose errors over all rows tell what is odd."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.iforest import spread

#: Units of the hidden layers, share of the first ones that is dropped, epochs, rows a step, share held out, epochs without a gain.
HIDDEN, DROPPED, EPOCHS, BATCH, HELD_OUT, PATIENCE = (10, 6, 10), 0.2, 50, 64, 0.1, 5
RATE, DECAY, SMALL = 1e-3, (0.9, 0.999), 1e-7
#: Rows of a key that its net is trained on, at most about; all rows are scored.
TRAINED_ON, SEED = 20_000, 42


@dataclass
class Net:
    """Weights and offsets of each layer; all but the last are rectified."""

    weights: list[np.ndarray]
    offsets: list[np.ndarray]

    @staticmethod
    def fresh(sizes: tuple[int, ...], rng: np.random.Generator) -> Net:
        """Uniform weights within the root of 6 over the units on both sides, offsets of zero."""
        pairs = list(zip(sizes, sizes[1:], strict=False))
        return Net([rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b)) for a, b in pairs], [np.zeros(b) for _, b in pairs])

    def layers(self, x: np.ndarray, masks: np.ndarray | None = None) -> list[np.ndarray]:
        """x and the output of each layer; masks, if any, multiply the first one's."""
        out = [x]
        for k, (w, b) in enumerate(zip(self.weights, self.offsets, strict=True)):
            y = out[-1] @ w + b
            if k < len(self.weights) - 1:
                y = np.maximum(y, 0)
            out.append(y * masks if k == 0 and masks is not None else y)
        return out

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared difference of each row from what comes out."""
        return np.mean((self.layers(x)[-1] - x) ** 2, axis=1)

    def gradients(self, x: np.ndarray, masks: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Those of the mean error over the rows, by weights and by offsets."""
        out = self.layers(x, masks)
        back = 2 * (out[-1] - x) / x.size
        by_weights, by_offsets = [], []
        for k in range(len(self.weights) - 1, -1, -1):
            by_weights.insert(0, out[k].T @ back)
            by_offsets.insert(0, back.sum(0))
            if k:
                back = (back @ self.weights[k].T) * (out[k] > 0)
                if k == 1 and masks is not None:
                    back = back * masks
        return by_weights, by_offsets


def train(x: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> Net:
    """A net for rows x: Adam over batches in a new order each epoch, until the held-out rows gain nothing for PATIENCE epochs; the best weights stay."""
    rng = np.random.default_rng(seed)
    net = Net.fresh((x.shape[1], *HIDDEN, x.shape[1]), rng)
    x = x[rng.permutation(len(x))]
    held = int(len(x) * HELD_OUT)
    check, rows = (x[:held], x[held:]) if held else (x, x)
    values = [*net.weights, *net.offsets]
    first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
    best, kept, waited, step = np.inf, [v.copy() for v in values], 0, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            some = rows[order[at : at + BATCH]]
            masks = (rng.random((len(some), HIDDEN[0])) >= DROPPED) / (1 - DROPPED)
            step += 1
            for v, g, m, s in zip(values, [g for kind in net.gradients(some, masks) for g in kind], first, second, strict=True):
                m += (1 - DECAY[0]) * (g - m)
                s += (1 - DECAY[1]) * (g * g - s)
                v -= RATE * (m / (1 - DECAY[0] ** step)) / (np.sqrt(s / (1 - DECAY[1] ** step)) + SMALL)
        loss = float(net.errors(check).mean())
        if loss < best:
            best, kept, waited = loss, [v.copy() for v in values], 0
        else:
            waited += 1
            if waited >= PATIENCE:
                break
    n = len(net.weights)
    return Net(kept[:n], kept[n:])


def fit_by(rows: DataFrame, by: str = "runnable", column: str = "z", id_columns: tuple[str, ...] = ("runnable", "t"), most: int = TRAINED_ON, seed: int = SEED) -> DataFrame:
    """(by, width, net): a net per key. A key with more than `most` rows gives those whose hash of the ids is in a share of most / n."""
    n = rows.groupBy(by).agg(F.count("*").alias("__n"))
    share = F.pmod(F.xxhash64(*id_columns, F.lit(seed)), F.lit(1 << 30))
    some = rows.select(by, F.col(column).alias("x"), share.alias("h")).join(n, by).where(F.col("h") < F.lit(float(most << 30)) / F.col("__n")).select(by, "x", "h")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf.assign(x=pdf["x"].map(tuple)).sort_values(["h", "x"])["x"].tolist(), float)
        net = train(x, seed)
        flat = np.concatenate([v.ravel() for v in (*net.weights, *net.offsets)])
        return pd.DataFrame({by: [pdf[by].iloc[0]], "width": [x.shape[1]], "net": [flat.tolist()]})

    return spread(some, by).groupBy(by).applyInPandas(build, f"{by} string, width int, net array<double>")


def unpacked(flat: np.ndarray, width: int) -> Net:
    sizes = (width, *HIDDEN, width)
    shapes = [*zip(sizes, sizes[1:], strict=False), *[(b,) for b in sizes[1:]]]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    parts = [p.reshape(s) for p, s in zip(np.split(np.asarray(flat, float), ends[:-1]), shapes, strict=True)]
    return Net(parts[: len(sizes) - 1], parts[len(sizes) - 1 :])


def errors_by(rows: DataFrame, nets: DataFrame, by: str = "runnable", column: str = "z", at_once: int = 200_000) -> DataFrame:
    """rows with error, by the net of their key; a key with more rows is dealt out in parts of about at_once. Rows of a key without a net are left out."""
    parts = rows.groupBy(by).agg(F.ceil(F.count("*") / F.lit(at_once)).cast("int").alias("__parts"))
    keep = rows.columns
    dealt = rows.join(parts, by).withColumn("__part", F.pmod(F.xxhash64(*[c for c in keep if c != column]), F.col("__parts")).cast("int")).drop("__parts")
    sent = nets.join(parts, by).select(by, "width", "net", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))

    def of(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in (*keep, "error")})
        net = unpacked(right["net"].iloc[0], int(right["width"].iloc[0]))
        return left[keep].assign(error=net.errors(np.array(left[column].tolist(), float)))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return spread(dealt, by, "__part").groupBy(by, "__part").cogroup(spread(sent, by, "__part").groupBy(by, "__part")).applyInPandas(of, f"{kinds}, error double")
