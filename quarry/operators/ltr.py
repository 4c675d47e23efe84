"""Learning to rank (Q25, Q26, Q65-Q76).

Features per (query_id, doc_id) come from the same aligned signals as the
scorers. Pointwise learners (least squares, ridge) fit from one
aggregation of sufficient statistics (sums of products -- map-side
partial aggregation, no data on the driver) and a d x d solve.

The pairwise linear SVM never builds the pair table. Its objective
    1/2 |w|^2 + C * sum over ordered pairs (i, j), rel_i != rel_j, of
    hinge(sign(rel_i - rel_j) * w.(x_i - x_j))
equals 1/2 |w|^2 + 2C * sum over rel_i > rel_j of max(0, 1 - s_i + s_j)
with s = w.x, and that sum (and its gradient) needs, per item, only how many
items of lower relevance violate the margin, and the sums of their features: prefix sums
in score order over dyadic blocks of relevance levels, n log(levels) rows whatever the number of levels,
answered by one range-partitioned sort per evaluation. The minimiser is found with
cutting planes on the driver (w has 5 or 10 entries); their dual gives a lower bound, so the
result comes with a certified duality gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import url_flag
from quarry.functions.vectors import sublinear
from quarry.operators.scoring import BM25FParams, _bm25_weight, averages_row
from quarry.operators.numbering import number_rows
from quarry.operators.signals import FIELDS, N_DOCS, idf

KEYS = ["query_id", "doc_id"]
F5 = [f"f_{f}" for f in FIELDS]
F10 = F5 + ["bm25f_text", "pagerank", "win_size", "pdf", "php"]


# ---------------------------------------------------------------- features
def _with_stats(tf: DataFrame, stats: DataFrame, cols: list) -> DataFrame:
    """``tf`` rows with their pair's stats; those that have them already (``copies``: how many rows of ``stats`` the pair has) need no join."""
    if "copies" in tf.columns:
        return tf.filter("copies > 0")
    return tf.join(stats.select(*KEYS, *cols), KEYS).withColumn("copies", F.lit(1))


def tfidf_features(tf: DataFrame, stats: DataFrame, norm_add: int, n_docs: int = N_DOCS) -> DataFrame:
    """(query_id, doc_id, f_url .. f_anchor): sum_t (q_tf * idf) * subl(tf_f) / (body_length + norm_add) (Q65).
    q_tf is the raw count here (not sublinear)."""
    rows = _with_stats(tf, stats, ["body_length"]).withColumn("qv", F.col("q_tf") * idf("df", n_docs) * F.col("copies"))
    denom = (F.col("body_length") + F.lit(norm_add)).cast("double")
    return rows.groupBy(*KEYS).agg(*[(F.sum(F.col("qv") * sublinear(f"tf_{f}") / denom)).alias(f"f_{f}") for f in FIELDS])


def extended_features(tf: DataFrame, stats: DataFrame, avg: DataFrame, windows: DataFrame, n_docs: int = N_DOCS, bm25: BM25FParams = BM25FParams()) -> DataFrame:
    """Ten features (Q66): tf-idf with +4000, BM25F without the pagerank prior,
    pagerank, min(body_length, smallest window), and the '.pdf' / '.php' url flags."""
    av = averages_row(avg)
    cols = ["body_length", "pagerank"] + [f"len_{f}" for f in FIELDS]
    rows = _with_stats(tf, stats, cols).withColumn("idf", idf("df", n_docs))
    rows = rows.withColumn("qv", F.col("q_tf") * F.col("idf") * F.col("copies"))
    p = bm25
    wt = _bm25_weight(p, av)
    denom = (F.col("body_length") + F.lit(4000)).cast("double")
    agg = rows.groupBy(*KEYS).agg(
        *[(F.sum(F.col("qv") * sublinear(f"tf_{f}") / denom)).alias(f"f_{f}") for f in FIELDS],
        F.sum(F.col("idf") * wt / (F.lit(p.k1) + wt) * F.col("copies")).alias("bm25f_text"),
    )
    flags = [url_flag("url", f".{x}").cast("double").alias(x) for x in ("pdf", "php")]
    s = stats.select(*KEYS, "pagerank", "body_length", *flags).join(windows, KEYS, "left")
    win = F.least(F.col("body_length").cast("double"), F.coalesce(F.col("min_window").cast("double"), F.lit(float("inf"))))
    s = s.select(*KEYS, F.col("pagerank").cast("double").alias("pagerank"), win.alias("win_size"), "pdf", "php")
    return agg.join(s, KEYS)


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Feature x label table of training (Q25, Q67): a pair without a label, or with a null one, is an error."""
    rel = F.when(F.col("rel").isNotNull(), F.col("rel")).otherwise(F.raise_error(F.lit("training pair without a relevance label")).cast("double"))
    return features.join(labels.select(*KEYS, "rel"), KEYS, "left").withColumn("rel", rel)


# ---------------------------------------------------------------- scaling
@dataclass
class Scaler:
    mean: np.ndarray
    scale: np.ndarray
    cols: list

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        out = [((F.col(c) - F.lit(float(m))) / F.lit(float(s))).alias(prefix + c) for c, m, s in zip(self.cols, self.mean, self.scale)]
        return df.select(*[c for c in df.columns if c not in self.cols], *out)


def fit_scaler(features: DataFrame, cols: Sequence[str]) -> Scaler:
    """Mean and population standard deviation per column; a zero deviation scales by 1 (Q68)."""
    row = features.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                       *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    mean = np.array([row[f"m{i}"] for i in range(len(cols))], dtype=float)
    std = np.array([row[f"s{i}"] for i in range(len(cols))], dtype=float)
    std[~(std > 0)] = 1.0
    return Scaler(mean, std, list(cols))


# ---------------------------------------------------------------- pointwise learners
@dataclass
class LinearModel:
    coef: np.ndarray
    intercept: float
    cols: list

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        s = F.lit(float(self.intercept))
        for c, w in zip(self.cols, self.coef):
            s = s + F.lit(float(w)) * F.col(c)
        return df.withColumn(out, s)


# A column whose variance, less what the columns before it explain, is a smaller share than this depends on them.
DEPENDENT = 1e-9


def solve_normal(a: np.ndarray, b: np.ndarray, alpha: float = 0.0) -> np.ndarray:
    """Weights of centred normal equations, columns in order: one that depends on those before it gets 0."""
    d = len(b)
    m = np.column_stack([a + alpha * np.eye(d), b]).astype(float)
    used = []
    for k in range(d):
        if m[k, k] <= DEPENDENT * (a[k, k] + alpha):
            continue
        used.append(k)
        for i in range(k + 1, d):
            m[i, k:] -= m[i, k] / m[k, k] * m[k, k:]
    w = np.zeros(d)
    for k in reversed(used):
        w[k] = (m[k, d] - m[k, k + 1 : d] @ w[k + 1 :]) / m[k, k]
    return w


def fit_least_squares(data: DataFrame, cols: Sequence[str], label: str = "rel", alpha: float = 0.0) -> LinearModel:
    """Least squares with an unpenalised intercept; ``alpha`` > 0 gives ridge (Q70, Q71).

    Two aggregations: the means, then the centred cross products (numerically
    stable); the (d x d) system is solved on the driver. A column that depends on
    the ones before it gets weight 0.
    """
    cols = list(cols)
    d = len(cols)
    m = data.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], F.avg(label).alias("my"), F.count(F.lit(1)).alias("n")).first()
    mx = np.array([m[f"m{i}"] for i in range(d)], dtype=float)
    my = float(m["my"])
    xc = [F.col(c) - F.lit(float(mx[i])) for i, c in enumerate(cols)]
    yc = F.col(label) - F.lit(my)
    sums = [F.sum(xc[i] * xc[j]).alias(f"a{i}_{j}") for i in range(d) for j in range(i, d)]
    sums += [F.sum(xc[i] * yc).alias(f"b{i}") for i in range(d)]
    r = data.agg(*sums).first()
    a = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            a[i, j] = a[j, i] = r[f"a{i}_{j}"]
    b = np.array([r[f"b{i}"] for i in range(d)], dtype=float)
    coef = solve_normal(a, b, alpha)
    return LinearModel(coef, my - float(mx @ coef), cols)


# ---------------------------------------------------------------- pairwise SVM without pairs
def _scan(d: int, n_weights: int, schema: pa.Schema):
    """mapInArrow body over a range-sorted partition of rows (group, wi, pt, s, x_0 .. x_d-1).

    Points (pt = 1) add (1, s, x) to the running sums of their group; a probe meets the sums of the points before it. A row
    of output holds, of a group: the probes' loss and gradient from this partition's points, what they need
    for points of earlier partitions (probes, sum of 1 - s, sum of x), and the sums of its own points. Only the
    partition's first and last group can go on elsewhere and are told apart; the others are one row per weight vector.
    """
    width = 2 * (d + 1) + 1 + (d + 2) + 1  # loss, grad | probes, sum(1 - s), sum(x) | points: n, sum(s), sum(x) | pairs

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        done = np.zeros((n_weights, width))
        first, open_key, open_wi, held, carry = None, None, 0, np.zeros(width), np.zeros(d + 2)

        def close():
            nonlocal first
            if first is None:
                first = (open_key, open_wi, held.copy())
            else:
                done[open_wi] += held

        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            keys = rb.column("g").to_pylist()
            codes = rb.column("g").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            wi, pt, s = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("wi", "pt", "s"))
            x = np.stack([rb.column(f"x{k}").to_numpy(zero_copy_only=False) for k in range(d)], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            seg = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            add = np.column_stack([np.ones(n), s, x]) * pt[:, None]
            before = np.cumsum(add, axis=0) - add
            before -= before[starts][seg]
            if keys[0] == open_key:
                before[seg == 0] += carry
            probe = (1 - pt)[:, None]
            loss = before[:, :1] * (1 - s[:, None]) + before[:, 1:2]
            grad = before[:, 2:] - before[:, :1] * x
            rows = np.concatenate([np.column_stack([loss, grad, np.ones(n), 1 - s, x]) * probe, add, before[:, :1] * probe], axis=1)
            sums = np.add.reduceat(rows, starts, axis=0)
            for k, at in enumerate(starts.tolist()):
                if keys[at] != open_key:
                    if open_key is not None:
                        close()
                    open_key, open_wi, held, carry = keys[at], int(wi[at]), np.zeros(width), np.zeros(d + 2)
                held = held + sums[k]
                carry = carry + sums[k, -(d + 3):-1]
        if open_key is None:
            return
        only = first is None
        out = [(pid, 0, *(first or (open_key, open_wi, held)))]
        out += [(pid, 1, "", w, done[w]) for w in range(n_weights) if done[w].any()]
        if not only:
            out.append((pid, 2, open_key, open_wi, held))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                                          pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.int32()),
                                          pa.array([r[4].tolist() for r in out], pa.list_(pa.float64()))], schema=schema)

    return run


class PairwiseHinge:
    """Pair-free evaluation of the pairwise hinge loss sum over rel_i > rel_j
    within a query, and its gradient, for items (query_id, rel, x_0..x_{d-1}).

    An item's relevance is a level number within its query. The levels below v are dyadic
    blocks, one for each bit of v; an item is a point of the blocks that hold its level and a probe of those
    below it. Any number of levels, continuous ones too, costs log2(levels) rows an item.
    """

    def __init__(self, items: DataFrame, cols: Sequence[str], query_col: str = "query_id", label: str = "rel"):
        # checkpoint, not persist: it also cuts the lineage, so each of the many
        # evaluations plans a small query instead of re-analysing the whole feature chain
        from quarry.session import checkpointed

        self.cols = list(cols)
        self.spark = items.sparkSession
        items = checkpointed(items.select(F.col(query_col).cast("string").alias("q"), F.col(label).cast("double").alias("rel"),
                                          *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(self.cols)]))
        levels = number_rows(items.select("q", "rel").distinct(), ["rel"], "lv", start=0, group_by=["q"])
        self.items = checkpointed(items.join(levels, ["q", "rel"]))
        self.bits = int(self.items.agg(F.max("lv")).first()[0] or 0).bit_length()

    def n_pairs(self) -> int:
        """Ordered pairs with differing relevance, from per-(query, level) counts."""
        c = self.items.groupBy("q", "rel").agg(F.count(F.lit(1)).alias("n"))
        t = c.groupBy("q").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("sq"))
        return int(t.agg(F.sum(F.col("t") * F.col("t") - F.col("sq"))).first()[0] or 0)

    def evaluate(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """(loss, gradient) at one weight vector."""
        return self.evaluate_all([w])[0][:2]

    def evaluate_all(self, weights: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray, int]]:
        """(loss, gradient, violating pairs) at each weight vector, in one job."""
        d, n_weights = len(self.cols), len(weights)
        if not self.bits:
            return [(0.0, np.zeros(d), 0) for _ in weights]
        xs = [F.col(f"x{k}") for k in range(d)]
        score = lambda w: sum((F.lit(float(w[k])) * xs[k] for k in range(d)), F.lit(0.0))
        at = F.explode(F.array(*[F.struct(F.lit(i).alias("wi"), score(w).alias("s")) for i, w in enumerate(weights)]))
        it = self.items.select("q", "lv", *xs, at.alias("e")).select("q", "lv", "e.wi", "e.s", *xs)
        roles = []
        for k in range(self.bits):
            block = F.shiftright("lv", k)
            # An odd block's items probe the even block before it.
            odd = block % 2 == 1
            key = F.when(odd, F.lit(1.0) - F.col("s")).otherwise(-F.col("s"))
            roles.append(F.struct(F.lit(k).alias("k"), (block - F.when(odd, 1).otherwise(0)).alias("b"), key.alias("key"), F.when(odd, 0).otherwise(1).alias("pt")))
        ev = it.select("wi", "s", *xs, "q", F.explode(F.array(*roles)).alias("r"))
        g = F.concat_ws("|", F.col("wi").cast("string"), F.col("r.k").cast("string"), F.col("r.b").cast("string"), "q")
        ev = ev.select(g.alias("g"), "wi", "r.key", "r.pt", "s", *xs)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # probes sort before points on equal keys: the margin is strict
        ev = ev.repartitionByRange(n, "g", "key", "pt").sortWithinPartitions("g", "key", "pt")
        arrow = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("g", pa.string()), ("wi", pa.int32()), ("v", pa.list_(pa.float64()))])
        out = ev.select("g", "wi", "pt", "s", *xs).mapInArrow(_scan(d, n_weights, arrow), "p int, kind int, g string, wi int, v array<double>")
        rows = out.collect()  # for each partition a row for each weight vector and two more
        total, n_viol = np.zeros((n_weights, d + 1)), np.zeros(n_weights)
        group, before = None, np.zeros(d + 2)
        for r in sorted(rows, key=lambda r: (r["p"], r["kind"])):
            v, wi = np.array(r["v"]), r["wi"]
            total[wi] += v[: d + 1]
            n_viol[wi] += v[-1]
            if r["kind"] == 1:
                continue
            probes, one_less, x, own = v[d + 1], v[d + 2], v[d + 3 : 2 * d + 3], v[2 * d + 3 : -1]
            if r["g"] != group:
                group, before = r["g"], np.zeros(d + 2)
            n_viol[wi] += before[0] * probes
            total[wi, 0] += before[0] * one_less + probes * before[1]
            total[wi, 1:] += probes * before[2:] - before[0] * x
            before = before + own
        return [(float(t[0]), t[1:].copy(), int(v)) for t, v in zip(total, n_viol, strict=True)]


def _best_combination(planes: np.ndarray, offsets: np.ndarray, start: np.ndarray, steps: int = 20_000) -> np.ndarray:
    """Shares of the planes that maximise offsets.b - |planes.b|^2 / 2 (sum 1, none negative), by moving share between the two that gain most."""
    b, gram = start.copy(), planes @ planes.T
    slope = offsets - gram @ b
    for _ in range(steps):
        up = int(slope.argmax())
        has = np.flatnonzero(b > 0)
        down = int(has[slope[has].argmin()])
        gain = slope[up] - slope[down]
        if gain <= 1e-12 * max(1.0, abs(slope[up])):
            break
        curve = gram[up, up] + gram[down, down] - 2 * gram[up, down]
        move = min(b[down], gain / curve) if curve > 0 else b[down]
        b[up] += move
        b[down] -= move
        slope -= move * (gram[up] - gram[down])
    return b


@dataclass
class SvmModel(LinearModel):
    primal: float = 0.0  # the objective at the weights
    lower: float = 0.0  # no weights have a smaller one


def fit_pairwise_svm(items: DataFrame, cols: Sequence[str], c: float = 3.0, gap: float = 1e-3, max_rounds: int = 80) -> SvmModel:
    """Linear SVM on pairwise differences (Q69, Q72): min 1/2|w|^2 + C * sum of
    hinge losses over all ordered differing-relevance pairs of each query.
    The pair set is symmetric, so the intercept is 0 and only w is learned.

    Cutting planes: the loss is above each of its tangents, so the best combination of the tangents so far bounds
    the objective from below (the dual). The loss is then read at several points towards that combination's weights,
    in one job. Ends when the objective is within ``gap`` (a share) of the bound; an error if it does not get there.
    """
    h = PairwiseHinge(items, cols)
    best, best_f = np.zeros(len(cols)), np.inf
    planes, offsets, share, lower = np.zeros((1, len(cols))), np.zeros(1), np.ones(1), 0.0  # the loss is never negative
    points = [best]
    for _ in range(max_rounds):
        for w, (loss, grad, _) in zip(points, h.evaluate_all(points), strict=True):
            f = 0.5 * w @ w + 2.0 * c * loss
            if f < best_f:
                best, best_f = w, f
            planes = np.vstack([planes, 2.0 * c * grad])
            offsets = np.append(offsets, 2.0 * c * (loss - grad @ w))
        share = _best_combination(planes, offsets, np.append(share, np.zeros(len(planes) - len(share))))
        lower = max(lower, float(offsets @ share - 0.5 * np.sum((share @ planes) ** 2)))
        if best_f - lower <= gap * max(best_f, 1e-9):
            return SvmModel(best, 0.0, list(cols), best_f, lower)
        w = -share @ planes
        points = [best + k * (w - best) for k in (0.1, 0.3, 0.6, 1.0)]
    raise RuntimeError(f"pairwise SVM: objective {best_f} is not within {gap} of its lower bound {lower} after {max_rounds} rounds")
