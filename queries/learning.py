"""Models, searches, explanations and scenario comparisons."""

from pyspark.sql import functions as F

from queries.joins import L2
from queries.registry import query
from queries.views import (
    LINE_FEATURES, ORD_NUMERIC, V_EMB, V_ORD, V_SCORE, documents_view, embeddings_view, orders_table, orders_view, rounded,
    scores_view, u_sql,
)
from tallymark.functions.rng import u
from tallymark.operators import cluster, encode, explain, folded, impute, models, profile, results, scale, search, split, trees
from tallymark.plans import scenario
from tallymark.session import written


def order_frame(spark, sf_dir):
    """Orders as ``key, label, vec``: gaps filled by the mean, standardised."""
    orders = orders_table(spark, sf_dir)
    filled = impute.fill_with(orders, impute.fit_mean(orders, LINE_FEATURES))
    scaled = scale.transform(filled, scale.fit_standard(filled, ORD_NUMERIC), ORD_NUMERIC)
    return written(scaled.select(
        F.col("o_orderkey").alias("key"), F.col("target").alias("label"), F.array(*ORD_NUMERIC).alias("vec")
    ))


# The same frame in SQL, one row per order and feature j, and Gaussian naive Bayes terms on it.
FRAME_FILL = ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in ORD_NUMERIC)
FRAME_LONG = " UNION ALL ".join(
    f"SELECT key, label, '{c}' AS j, ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS v FROM filled" for c in ORD_NUMERIC
)
V_FRAME = f"""{V_ORD}, filled AS (SELECT o_orderkey AS key, target AS label, {FRAME_FILL} FROM v_ord), x AS ({FRAME_LONG})"""
BAYES_TERM = "(-0.5 * ln(2 * pi() * (s + floor)) - ({v} - m) * ({v} - m) / (2 * (s + floor)))"


def document_frame(spark, sf_dir):
    """Labelled documents with numeric and coded features."""
    docs = documents_view(spark, sf_dir).filter(F.col("quality").isNotNull())
    coded = encode.label_encode(docs, ["lang", "source"])
    names = ["n_chars", "n_words", "n_lines", "lang", "source"]
    columns = [F.col(c).cast("double").alias(c) for c in names]
    return scenario.Frame(coded.select(F.col("doc_id").alias("key"), F.col("quality").alias("label"), *columns), names)


def _classify(spark, sf_dir, model, params=None):
    """Fit on 70 % of the orders, score the rest."""
    marked = written(split.stratified_split(order_frame(spark, sf_dir), "key", "label", 0.3))
    predict = models.fit(model, marked.filter(~F.col("is_test")), params)
    scored = predict(marked.filter("is_test"))
    return scored.select("key", "label", *rounded("score"), "prediction")


@query("clf_logistic")
def clf_logistic(spark, sf_dir):
    return _classify(spark, sf_dir, "logistic", {"C": 1.0, "penalty": "l2"})


@query("clf_tree")
def clf_tree(spark, sf_dir):
    return _classify(spark, sf_dir, "tree", {"max_depth": 5, "criterion": "entropy"})


@query("clf_forest")
def clf_forest(spark, sf_dir):
    return _classify(spark, sf_dir, "forest", {"n_estimators": 100, "max_depth": 5, "min_samples_leaf": 5})


@query("clf_gbt")
def clf_gbt(spark, sf_dir):
    return _classify(spark, sf_dir, "boosting", {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8})


@query("clf_svm_rff")
def clf_svm_rff(spark, sf_dir):
    return _classify(spark, sf_dir, "svm", {"C": 10.0, "gamma": 0.1, "class_weight": "balanced"})


@query("clf_mlp")
def clf_mlp(spark, sf_dir):
    return _classify(spark, sf_dir, "perceptron")


@query("clf_knn", f"""
WITH {V_EMB}, d AS (
  SELECT a.vec_id, b.anomalous AS y, {L2} AS distance, b.vec_id AS other FROM v_emb a JOIN v_emb b ON a.part = 'test' AND b.part = 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, other) AS r FROM d),
e AS (SELECT vec_id, avg(y) AS even FROM r WHERE r <= 5 GROUP BY 1),
w AS (SELECT vec_id, CASE WHEN count(*) FILTER (distance = 0) > 0 THEN avg(y) FILTER (distance = 0)
                          ELSE sum(y / distance) FILTER (distance > 0) / sum(1 / distance) FILTER (distance > 0) END AS near
      FROM r WHERE r <= 7 GROUP BY 1)
SELECT vec_id, round(even, 6) AS even, CAST(even > 0.5 AS INTEGER) AS even_class, round(near, 6) AS near,
       CAST(near > 0.5 AS INTEGER) AS near_class FROM e JOIN w USING (vec_id)""")
def clf_knn(spark, sf_dir):
    frame = embeddings_view(spark, sf_dir).select(F.col("vec_id").alias("key"), F.col("anomalous").alias("label"), "vec", "part")
    train, test = frame.filter("part = 'train'"), frame.filter("part = 'test'")
    even = models.fit("knn", train, {"n_neighbors": 5})(test)
    near = models.fit("knn", train, {"n_neighbors": 7, "weights": "distance"})(test)
    left = even.select(F.col("key").alias("vec_id"), F.col("score").alias("even"), F.col("prediction").alias("even_class"))
    right = near.select(F.col("key").alias("vec_id"), F.col("score").alias("near"), F.col("prediction").alias("near_class"))
    return left.join(right, "vec_id").select("vec_id", *rounded("even"), "even_class", *rounded("near"), "near_class")


NB = ["o_totalprice", "c_acctbal", "n_lines"]
NB_STATS = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in NB)
NB_FLOOR = "1e-9 * greatest(" + ", ".join(f"(SELECT var_pop({c}) FROM f)" for c in NB) + ")"
NB_TERMS = " + ".join(
    f"(-0.5 * ln(2 * pi() * (v_{c} + floor)) - ({c} - m_{c}) * ({c} - m_{c}) / (2 * (v_{c} + floor)))" for c in NB
)


@query("clf_gnb", f"""
WITH {V_ORD}, f AS (SELECT o_orderkey, target, o_totalprice, c_acctbal, coalesce(n_lines, (SELECT avg(n_lines) FROM v_ord)) AS n_lines FROM v_ord),
s AS (SELECT target AS k, count(*) / (SELECT count(*) FROM f) AS prior, {NB_STATS}, {NB_FLOOR} AS floor FROM f GROUP BY 1),
j AS (SELECT o_orderkey, any_value(target) AS label, max(CASE WHEN k = 1 THEN ln(prior) + {NB_TERMS} END) AS l1,
             max(CASE WHEN k = 0 THEN ln(prior) + {NB_TERMS} END) AS l0 FROM f, s GROUP BY 1)
SELECT o_orderkey, label, round(1 / (1 + exp(l0 - l1)), 6) AS score, CAST(l1 > l0 AS INTEGER) AS prediction FROM j""")
def clf_gnb(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    frame = impute.fill_with(orders, impute.fit_mean(orders, ["n_lines"])).select(
        F.col("o_orderkey").alias("key"), F.col("target").alias("label"), F.array(*NB).alias("vec")
    )
    scored = models.fit("bayes", frame)(frame)
    return scored.select(F.col("key").alias("o_orderkey"), "label", *rounded("score"), "prediction")


def _cluster_frame(spark, sf_dir):
    return order_frame(spark, sf_dir).select("key", "vec")


DIMS = range(1, len(ORD_NUMERIC) + 1)
POINTS = f"""{V_ORD}, filled AS (SELECT o_orderkey AS key, {FRAME_FILL} FROM v_ord),
p AS (SELECT key, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i}" for i, c in enumerate(ORD_NUMERIC, 1))} FROM filled),
tol AS (SELECT {cluster.TOLERANCE} * ({" + ".join(f"var_pop(x{i})" for i in DIMS)}) / {len(ORD_NUMERIC)} AS tol FROM p), st AS (SELECT unnest(range({cluster.RESTARTS})) AS s)"""


def _square(c: int) -> str:
    """Squared distance of a point to centre c of the list m, which holds one centre after the other."""
    return " + ".join(f"(x{i} - m[{c * len(ORD_NUMERIC) + i}]) * (x{i} - m[{c * len(ORD_NUMERIC) + i}])" for i in DIMS)


def _seeds_sql(k: int) -> str:
    """c1 .. ck: for each start s the list m of its first centres by k-means++."""
    point = "[" + ", ".join(f"x{i}" for i in DIMS) + "]"
    first = u_sql("key", "'start' || s || '_0'")
    steps = [f"c1 AS (SELECT s, min({{'t': {first}, 'key': key, 'v': {point}}}).v AS m FROM p, st GROUP BY s)"]
    for j in range(1, k):
        near = f"least({', '.join(_square(c) for c in range(j))})" if j > 1 else _square(0)
        draw = u_sql("key", f"'start' || s || '_{j}'")
        steps.append(f"""c{j + 1} AS (SELECT s, list_concat(m, min({{'t': CASE WHEN d > 0 THEN -ln(u) / d ELSE 'inf'::DOUBLE END, 'key': key, 'v': v}}).v) AS m
            FROM (SELECT s, m, key, {point} AS v, {draw} AS u, {near} AS d FROM p, c{j}) GROUP BY s, m)""")
    return ", ".join(steps)


def _lloyd_sql(k: int) -> str:
    """e{k}: the settled centres m of every start; b{k}: the best start with its inertia."""
    gaps = ", ".join(f"{_square(c)} AS d{c}" for c in range(k))
    nearest = f"list_position([{', '.join(f'd{c}' for c in range(k))}], least({', '.join(f'd{c}' for c in range(k))})) - 1" if k > 1 else "0"
    means = ", ".join(f"coalesce(avg(x{i}) FILTER (cl = {c}), m[{c * len(ORD_NUMERIC) + i}])" for c in range(k) for i in DIMS)
    least = f"least({', '.join(f'd{c}' for c in range(k))})" if k > 1 else "d0"
    return f"""l{k} AS (SELECT s, m, m AS old, 'inf'::DOUBLE AS moved FROM c{k} UNION ALL
      SELECT s, n, m, list_sum(list_transform(list_zip(n, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) FROM (
        SELECT s, m, [{means}] AS n FROM (SELECT *, {nearest} AS cl FROM (SELECT s, m, p.*, {gaps} FROM l{k}, p WHERE moved > (SELECT tol FROM tol))) GROUP BY s, m)),
    e{k} AS (SELECT s, old AS m FROM l{k} WHERE moved <= (SELECT tol FROM tol)),
    b{k} AS (SELECT s, m, inertia FROM (SELECT s, m, sum({least}) AS inertia FROM (SELECT s, m, {gaps} FROM e{k}, p) GROUP BY s, m) ORDER BY round(inertia, 6), s LIMIT 1)"""


ASSIGNED = f"""WITH RECURSIVE {POINTS}, {_seeds_sql(4)}, {_lloyd_sql(4)},
a AS (SELECT key, CAST(list_position([d0, d1, d2, d3], least(d0, d1, d2, d3)) - 1 AS INTEGER) AS cluster
      FROM (SELECT key, {", ".join(f"{_square(c)} AS d{c}" for c in range(4))} FROM p, b4))"""


@query("kmeans_assign", f"{ASSIGNED} SELECT key, cluster FROM a")
def kmeans_assign(spark, sf_dir):
    frame = _cluster_frame(spark, sf_dir)
    return cluster.assign(frame, cluster.kmeans(frame, [4])[4].centres).select("key", "cluster")


@query("kmeans_sizes", f"{ASSIGNED} SELECT cluster, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS percent FROM a GROUP BY 1")
def kmeans_sizes(spark, sf_dir):
    frame = _cluster_frame(spark, sf_dir)
    return profile.value_counts(cluster.assign(frame, cluster.kmeans(frame, [4])[4].centres), "cluster")


@query("kmeans_elbow", f"""WITH RECURSIVE {POINTS}, {_seeds_sql(10)}, {", ".join(_lloyd_sql(k) for k in range(1, 11))}
{" UNION ALL ".join(f"SELECT {k} AS k, round(inertia, 4) AS inertia FROM b{k}" for k in range(1, 11))}""")
def kmeans_elbow(spark, sf_dir):
    return cluster.elbow(_cluster_frame(spark, sf_dir), range(1, 11)).select("k", *rounded("inertia", digits=4))


START = u_sql("vec_id", "'start'")


@query("lloyd_step", f"""
WITH {V_EMB}, c AS (SELECT vec AS centre, row_number() OVER (ORDER BY {START}, vec_id) - 1 AS cluster FROM v_emb QUALIFY cluster < 4),
d AS (SELECT a.vec_id, a.vec, cluster, row_number() OVER (PARTITION BY a.vec_id ORDER BY {L2.replace('b.vec', 'c.centre')}, cluster) AS r
      FROM v_emb a, c),
e AS (SELECT cluster, vec_id, unnest(vec) AS x, unnest(range(64)) AS i FROM d WHERE r = 1),
m AS (SELECT cluster, i, avg(x) AS x, count(*) AS n FROM e GROUP BY 1, 2)
SELECT CAST(cluster AS INTEGER) AS cluster, any_value(n) AS n, list(round(x, 6) ORDER BY i) AS centre FROM m GROUP BY 1""")
def lloyd_step(spark, sf_dir):
    vectors = embeddings_view(spark, sf_dir)
    centres = [r["vec"] for r in vectors.orderBy(u("vec_id", "start"), "vec_id").limit(4).collect()]
    step = models.lloyd_step(vectors, centres)
    return step.select("cluster", "n", F.transform("centre", lambda x: F.round(x, 6)).alias("centre"))


TREE_COLUMNS = ["o_totalprice", "c_acctbal", "n_lines", "sum_qty", "sum_price"]
TREE_DEPTH, TREE_BINS, TREE_ROWS = 4, 32, 5


def _bits(n: str, p: str) -> str:
    return f"(CASE WHEN {p} = 0 OR {p} = {n} THEN 0 ELSE -({p} / {n}) * log2({p} / {n}) - (1 - {p} / {n}) * log2(1 - {p} / {n}) END)"


def _level_sql(level: int) -> str:
    """b{level}: the best split of each node of a level; r{level + 1}: the rows after it."""
    return f"""h{level} AS (SELECT node, j, bin, count(*) AS n, sum(label) AS p FROM r{level} JOIN bins USING (key) WHERE node >= {2**level} GROUP BY 1, 2, 3),
w{level} AS (SELECT node, j, bin, sum(n) OVER u AS ln, sum(p) OVER u AS lp, sum(n) OVER a AS n, sum(p) OVER a AS p FROM h{level}
      WINDOW u AS (PARTITION BY node, j ORDER BY bin), a AS (PARTITION BY node, j)),
b{level} AS (SELECT node, j, bin, gain FROM (SELECT *, round({_bits('n', 'p')} - ln / n * {_bits('ln', 'lp')} - (n - ln) / n * {_bits('(n - ln)', '(p - lp)')}, 9) AS gain
      FROM w{level} WHERE ln >= {TREE_ROWS} AND n - ln >= {TREE_ROWS}) WHERE gain > 0
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, j, bin) = 1),
r{level + 1} AS (SELECT r.key, r.label, CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node + CAST(x.bin > b.bin AS BIGINT) END AS node
      FROM r{level} r LEFT JOIN b{level} b ON b.node = r.node LEFT JOIN bins x ON x.key = r.key AND x.j = b.j)"""


V_TREE = f"""{V_ORD}, filled AS (SELECT o_orderkey AS key, target AS label, {FRAME_FILL} FROM v_ord),
wide AS ({" UNION ALL ".join(f"SELECT key, '{c}' AS j, {c} AS v FROM filled" for c in TREE_COLUMNS)}),
edge AS (SELECT j, min(v) AS lo, max(v) AS hi FROM wide GROUP BY 1),
bins AS (SELECT key, wide.j, CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * {TREE_BINS}), {TREE_BINS - 1}) ELSE 0 END AS bin FROM wide JOIN edge ON edge.j = wide.j),
r0 AS (SELECT key, label, 1::BIGINT AS node FROM filled), {", ".join(_level_sql(level) for level in range(TREE_DEPTH))}"""


def tree_frame(spark, sf_dir):
    orders = orders_table(spark, sf_dir)
    filled = impute.fill_with(orders, impute.fit_mean(orders, LINE_FEATURES))
    return filled.select(F.col("o_orderkey").alias("key"), F.col("target").alias("label"), *TREE_COLUMNS)


@query("tree_split_step", f"""
WITH {V_TREE}, n AS (SELECT node, count(*) AS n, sum(label)::BIGINT AS positives FROM (
  SELECT unnest(list_transform(range(0, {TREE_DEPTH + 1}), lambda i: node // CAST(pow(2, i) AS BIGINT))) AS node, label FROM r{TREE_DEPTH}) WHERE node > 0 GROUP BY 1),
b AS ({" UNION ALL ".join(f"SELECT * FROM b{level}" for level in range(TREE_DEPTH))})
SELECT n.node, b.j AS feature, CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin + 1) * (hi - lo) / {TREE_BINS}, 4) AS cut, round(gain, 6) AS gain, n, positives
FROM n LEFT JOIN b ON b.node = n.node LEFT JOIN edge ON edge.j = b.j""")
def tree_split_step(spark, sf_dir):
    """All nodes of a tree of four levels: split, gain, rows and positives."""
    tree = trees.grow(tree_frame(spark, sf_dir), TREE_COLUMNS, depth=TREE_DEPTH, bins=TREE_BINS, min_rows=TREE_ROWS)
    return tree.nodes.select("node", "feature", "bin", *rounded("cut", digits=4), *rounded("gain"), "n", "positives")


@query("tree_predict", f"""
WITH {V_TREE} SELECT key, label, node, round(avg(label) OVER (PARTITION BY node), 6) AS score FROM r{TREE_DEPTH}""")
def tree_predict(spark, sf_dir):
    """The leaf of every order and its share of class 1."""
    frame = tree_frame(spark, sf_dir)
    tree = trees.grow(frame, TREE_COLUMNS, depth=TREE_DEPTH, bins=TREE_BINS, min_rows=TREE_ROWS)
    return frame.select("key", "label").join(trees.predict(frame, tree), "key").select("key", "label", "node", *rounded("score"))


# The six models of the ablation study with their defaults: 100 trees, 100 rounds, 5 neighbours.
CANDIDATES = {name: (name, {}) for name in ("logistic", "forest", "svm", "bayes", "boosting", "knn")}
FOLDS = 10

V_FOLDED = f"""{V_FRAME},
d AS (SELECT key, label, (row_number() OVER (PARTITION BY label ORDER BY {u_sql('key', "'fold'")}, key) - 1) % {FOLDS} AS fold FROM filled),
y AS (SELECT x.*, fold FROM x JOIN d ON d.key = x.key), f AS (SELECT unnest(range({FOLDS})) AS f),
wide AS (SELECT f, max(s) AS widest FROM (SELECT f, j, var_pop(v) AS s FROM y JOIN f ON fold <> f GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT f, label AS k, j, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM y JOIN f ON fold <> f GROUP BY 1, 2, 3),
prior AS (SELECT f, k, ln(any_value(n) / sum(any_value(n)) OVER (PARTITION BY f)) AS prior FROM s GROUP BY 1, 2)"""
COUNTS = "count(*) FILTER (hit AND label = 1) AS tp, count(*) FILTER (hit AND label = 0) AS fp, count(*) FILTER (NOT hit AND label = 1) AS fn, count(*) FILTER (NOT hit AND label = 0) AS tn"
RATIOS = "(tp + tn) / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS \"precision\", CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall, CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"
SHOWN = ("bayes", "knn")


@query("cv_scores", f"""
WITH {V_FOLDED},
l AS (SELECT y.key, any_value(y.label) AS label, any_value(y.fold) AS fold, s.k, any_value(prior) + sum({BAYES_TERM.format(v='v').replace('floor', '1e-9 * widest')}) AS l
      FROM y JOIN s ON s.f = y.fold AND s.j = y.j JOIN wide w ON w.f = y.fold JOIN prior p ON p.f = y.fold AND p.k = s.k GROUP BY y.key, s.k),
b AS (SELECT key, any_value(fold) AS fold, any_value(label) AS label, max(l) FILTER (k = 1) > max(l) FILTER (k = 0) AS hit FROM l GROUP BY 1),
pts AS (SELECT key, any_value(label) AS label, any_value(fold) AS fold, {", ".join(f"max(v) FILTER (j = '{c}') AS x{i}" for i, c in enumerate(ORD_NUMERIC))} FROM y GROUP BY 1),
near AS (SELECT a.key, a.fold, a.label, min({{'d': {" + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(ORD_NUMERIC)))}, 'k': b.key, 'y': b.label}}, 5) AS near
         FROM pts a JOIN pts b ON a.fold <> b.fold GROUP BY 1, 2, 3),
n AS (SELECT key, fold, label, list_avg(list_transform(near, lambda z: z.y)) > 0.5 AS hit FROM near),
c AS (SELECT 'bayes' AS model, fold, {COUNTS} FROM b GROUP BY fold UNION ALL SELECT 'knn', fold, {COUNTS} FROM n GROUP BY fold),
r AS (SELECT *, {RATIOS} FROM c),
a AS (SELECT m AS model, fold, count(*) AS n, sum(label)::BIGINT AS positives FROM d, (SELECT unnest({list(CANDIDATES)}) AS m) GROUP BY 1, 2)
SELECT a.model, CAST(a.fold AS INTEGER) AS fold, n, positives, true AS metrics_agree, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM a LEFT JOIN r ON r.model = a.model AND r.fold = a.fold""")
def cv_scores(spark, sf_dir):
    """Ten folds of six models. The metrics of Bayes and neighbours are shown; those of every model must follow from its counts."""
    folds = search.cross_validate(order_frame(spark, sf_dir), CANDIDATES, FOLDS)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    again = {
        "accuracy": (tp + tn) / n, "precision": F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp)), "recall": F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn)),
        "f1": F.when(tp == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn)),
    }
    agree = F.col("auc").between(0, 1)
    for c, value in again.items():
        agree = agree & (F.abs(F.col(c) - value) < 1e-12)
    shown = F.col("model").isin(*SHOWN)
    return folds.select(
        "model", "fold", n.alias("n"), (tp + fn).alias("positives"), agree.alias("metrics_agree"), *[F.when(shown, F.col(c)).alias(c) for c in ("tp", "fp", "fn", "tn")],
        *[F.round(F.when(shown, F.col(c)), 6).alias(c) for c in again],
    )


NEWTON_C = (0.1, 1.0, 10.0)
# Steps of Newton's method with the three-by-three system solved by determinants; twelve are far more than it needs.
MINORS = {
    "d1": "g1 * (h22 * h33 - h23 * h23) - h12 * (g2 * h33 - h23 * g3) + h13 * (g2 * h23 - h22 * g3)",
    "d2": "h11 * (g2 * h33 - h23 * g3) - g1 * (h12 * h33 - h23 * h13) + h13 * (h12 * g3 - g2 * h13)",
    "d3": "h11 * (h22 * g3 - g2 * h23) - h12 * (h12 * g3 - g2 * h13) + g1 * (h12 * h23 - h22 * h13)",
    "d": "h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13)",
}


@query("logistic_newton", f"""
WITH RECURSIVE {V_FOLDED},
pts AS (SELECT key, any_value(label) AS label, any_value(fold) AS fold, max(v) FILTER (j = 'o_totalprice') AS x1, max(v) FILTER (j = 'c_acctbal') AS x2 FROM y GROUP BY 1),
cs AS (SELECT f, c, balanced, 1 / (c * count(*)) AS lam, count(*) / (2 * count(*) FILTER (label = 0)) AS k0, count(*) / (2 * count(*) FILTER (label = 1)) AS k1
       FROM pts, f, (SELECT unnest({list(NEWTON_C)}::DOUBLE[]) AS c), (SELECT unnest([false, true]) AS balanced) WHERE fold <> f GROUP BY 1, 2, 3),
nw AS (SELECT *, 0 AS step, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS w3 FROM cs UNION ALL
  SELECT f, c, balanced, lam, k0, k1, step + 1, w1 - ({MINORS['d1']}) / ({MINORS['d']}), w2 - ({MINORS['d2']}) / ({MINORS['d']}), w3 - ({MINORS['d3']}) / ({MINORS['d']}) FROM (
    SELECT f, c, balanced, lam, k0, k1, step, w1, w2, w3, avg(k * (p - label) * x1) + lam * w1 AS g1, avg(k * (p - label) * x2) + lam * w2 AS g2, avg(k * (p - label)) AS g3,
           avg(k * p * (1 - p) * x1 * x1) + lam AS h11, avg(k * p * (1 - p) * x1 * x2) AS h12, avg(k * p * (1 - p) * x1) AS h13,
           avg(k * p * (1 - p) * x2 * x2) + lam AS h22, avg(k * p * (1 - p) * x2) AS h23, avg(k * p * (1 - p)) AS h33
    FROM (SELECT nw.*, x1, x2, label, CASE WHEN NOT balanced THEN 1 WHEN label = 1 THEN k1 ELSE k0 END AS k, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + w3))) AS p
          FROM nw, pts WHERE fold <> f AND step < 12) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10))
SELECT CAST(f AS INTEGER) AS fold, c AS "C", balanced, round(w1, 6) AS w_totalprice, round(w2, 6) AS w_acctbal, round(w3, 6) AS intercept FROM nw WHERE step = 12""")
def logistic_newton(spark, sf_dir):
    """Sixty logistic regressions (fold left out, penalty, class weights) from shared passes of gradients and Hessians."""
    frame = order_frame(spark, sf_dir).select("key", "label", F.slice("vec", 1, 2).alias("vec"))
    parts = written(split.stratified_folds(frame, "key", "label", FOLDS))
    sizes = {r["fold"]: r["count"] for r in parts.groupBy("fold").count().collect()}
    rows = sum(sizes.values())
    grid = [(fold, c, balanced) for fold in range(FOLDS) for c in NEWTON_C for balanced in (False, True)]
    weights = folded.newton(parts, [(fold, 1.0 / (c * (rows - sizes[fold])), 0.0, balanced) for fold, c, balanced in grid])
    found = [(*g, *w.tolist()) for g, w in zip(grid, weights)]
    table = spark.createDataFrame(found, "fold int, C double, balanced boolean, w_totalprice double, w_acctbal double, intercept double")
    return table.select("fold", "C", "balanced", *rounded("w_totalprice", "w_acctbal", "intercept"))


@query("oof_predictions", f"""
WITH {V_FRAME},
d AS (SELECT key, (row_number() OVER (PARTITION BY label ORDER BY {u_sql('key', "'fold'")}, key) - 1) % 5 AS fold FROM filled),
y AS (SELECT x.*, fold FROM x JOIN d ON d.key = x.key), f AS (SELECT unnest(range(5)) AS f),
w AS (SELECT f, 1e-9 * max(s) AS floor FROM (SELECT f, j, var_pop(v) AS s FROM y JOIN f ON fold <> f GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT f, label AS k, j, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM y JOIN f ON fold <> f GROUP BY 1, 2, 3),
p AS (SELECT f, k, ln(any_value(n) / sum(any_value(n)) OVER (PARTITION BY f)) AS prior FROM s GROUP BY 1, 2),
l AS (SELECT y.key, any_value(y.label) AS label, any_value(y.fold) AS fold, s.k,
             any_value(prior) + sum({BAYES_TERM.format(v='v')}) AS l
      FROM y JOIN s ON s.f = y.fold AND s.j = y.j JOIN w ON w.f = y.fold JOIN p ON p.f = y.fold AND p.k = s.k GROUP BY y.key, s.k),
o AS (SELECT key, any_value(fold) AS fold, any_value(label) AS label, max(l) FILTER (k = 1) AS l1, max(l) FILTER (k = 0) AS l0 FROM l GROUP BY 1)
SELECT key, CAST(fold AS INTEGER) AS fold, label, round(1 / (1 + exp(l0 - l1)), 6) AS score, CAST(l1 > l0 AS INTEGER) AS prediction FROM o""")
def oof_predictions(spark, sf_dir):
    found = search.held_out_predictions(order_frame(spark, sf_dir), {"bayes": ("bayes", {})}, 5)
    return found.select("key", "fold", "label", *rounded("score"), "prediction")


@query("grid_search", f"""
SELECT CAST(row_number() OVER (ORDER BY c, p) AS INTEGER) AS experiment, c AS "C", p AS penalty, true AS in_range, true AS penalty_shrinks
FROM (SELECT unnest([0.1, 10.0]::DOUBLE[]) AS c), (SELECT unnest(['l1', 'l2']) AS p)""")
def grid_search(spark, sf_dir):
    """Ten folds of each combination; a stronger penalty gives smaller weights on all rows."""
    axes = {"C": [0.1, 10.0], "penalty": ["l1", "l2"]}
    frame = order_frame(spark, sf_dir)
    found = search.grid_search(frame, "logistic", axes, FOLDS)
    rows = frame.count()
    grid = [(c, p) for c in axes["C"] for p in axes["penalty"]]
    weights = folded.newton(frame.withColumn("fold", F.lit(0)), [(None, 1.0 / (c * rows), float(p == "l1"), False) for c, p in grid])
    size = {(c, p): float(abs(w[:-1]).sum() if p == "l1" else (w[:-1] ** 2).sum()) for (c, p), w in zip(grid, weights)}
    shrinks = {p: size[0.1, p] <= size[10.0, p] for p in axes["penalty"]}
    told = F.element_at(F.create_map(*[F.lit(x) for pair in shrinks.items() for x in pair]), F.col("penalty"))
    return found.select("experiment", "C", "penalty", (F.col("f1_mean").between(0, 1) & (F.col("f1_std") >= 0)).alias("in_range"), told.alias("penalty_shrinks"))


T_DRAW = {n: u_sql("trial", f"'{n}'") for n in ("C", "penalty", "threshold")}


@query("search_trials", f"""
WITH {V_SCORE}, n AS (SELECT count(*) AS n FROM v_score),
t AS (SELECT CAST(trial AS INTEGER) AS trial, exp(ln(0.01) + {T_DRAW['C']} * (ln(10) - ln(0.01))) AS c,
             ['l1', 'l2'][CAST(floor({T_DRAW['penalty']} * 2) AS INTEGER) + 1] AS penalty, {T_DRAW['threshold']} AS threshold
      FROM (SELECT unnest(range(30)) AS trial)),
g AS (SELECT trial, any_value(c) AS c, any_value(penalty) AS penalty, any_value(threshold) AS threshold,
             count(*) FILTER (score >= threshold AND label = 1) AS tp, count(*) FILTER (score >= threshold AND label = 0) AS fp,
             count(*) FILTER (score < threshold AND label = 1) AS fn FROM t, v_score GROUP BY 1)
SELECT trial, round(c, 6) AS "C", penalty, round(1e6 / (c * (SELECT n FROM n)), 4) AS reg_param_e6, round(threshold, 6) AS threshold, tp, fp, fn,
       round(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM g""")
def search_trials(spark, sf_dir):
    """Thirty drawn parameter sets; the drawn threshold of each is scored on the orders in one aggregation."""
    scores = scores_view(spark, sf_dir)
    space = {**search.SESSION_SPACES["logistic"], "threshold": ("float", 0.0, 1.0)}
    trials = search.trial_table(spark, space, 30)
    rows = trials.orderBy("trial").collect()
    cuts = [(r["trial"], F.col("score") >= F.lit(r["threshold"])) for r in rows]
    positive = F.col("label") == 1
    counts = scores.agg(F.count(F.lit(1)).alias("n"), *[
        a for t, hit in cuts
        for a in (F.count_if(hit & positive).alias(f"tp{t}"), F.count_if(hit & ~positive).alias(f"fp{t}"), F.count_if(~hit & positive).alias(f"fn{t}"))
    ])
    cells = [
        F.struct(F.lit(t).alias("trial"), F.col("n").alias("n"), *[F.col(f"{c}{t}").alias(c) for c in ("tp", "fp", "fn")])
        for t, _ in cuts
    ]
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = trials.join(counts.select(F.inline(F.array(*cells))), "trial")
    return scored.select(
        "trial", *rounded("C"), "penalty", F.round(1e6 / (F.col("C") * F.col("n")), 4).alias("reg_param_e6"), *rounded("threshold"),
        "tp", "fp", "fn", F.round(F.when(tp == 0, 0.0).otherwise(2 * tp / (2 * tp + fp + fn)), 6).alias("f1"),
    )


@query("search_best", f"""
WITH {V_FOLDED},
t AS (SELECT CAST(trial AS INTEGER) AS trial, exp(ln(1e-12) + {u_sql('trial', "'var_smoothing'")} * (ln(1e-6) - ln(1e-12))) AS var_smoothing FROM (SELECT unnest(range(30)) AS trial)),
l AS (SELECT trial, y.key, any_value(y.label) AS label, any_value(y.fold) AS fold, s.k, any_value(prior) + sum({BAYES_TERM.format(v='v').replace('floor', 'var_smoothing * widest')}) AS l
      FROM y JOIN s ON s.f = y.fold AND s.j = y.j JOIN wide w ON w.f = y.fold JOIN prior p ON p.f = y.fold AND p.k = s.k, t GROUP BY trial, y.key, s.k),
b AS (SELECT trial, key, any_value(fold) AS fold, any_value(label) AS label, max(l) FILTER (k = 1) > max(l) FILTER (k = 0) AS hit FROM l GROUP BY 1, 2),
r AS (SELECT *, {RATIOS} FROM (SELECT trial, fold, {COUNTS} FROM b GROUP BY 1, 2)),
m AS (SELECT trial, round(avg(f1), 9) AS f1_mean, stddev_pop(f1) AS f1_std FROM r GROUP BY 1)
SELECT trial, 'bayes' AS model, round(var_smoothing * 1e9, 6) AS var_smoothing_e9, round(f1_mean, 6) AS f1_mean, round(f1_std, 6) AS f1_std
FROM m JOIN t USING (trial) ORDER BY m.f1_mean DESC, trial LIMIT 1""")
def search_best(spark, sf_dir):
    """Thirty trials over ten folds."""
    searched = search.random_search(order_frame(spark, sf_dir), "bayes", search.ABLATION_SPACES["bayes"], 30, FOLDS)
    best = results.top_rows(searched.withColumn("f1_mean", F.round("f1_mean", 9)), "f1_mean", ["trial"], 1)
    return best.select("trial", "model", F.round(F.col("var_smoothing") * 1e9, 6).alias("var_smoothing_e9"), *rounded("f1_mean", "f1_std"))


@query("importance_select")
def importance_select(spark, sf_dir):
    weights = explain.forest_importance(order_frame(spark, sf_dir), ORD_NUMERIC, {"max_depth": 4, "n_estimators": 100})
    return weights.select("feature", *rounded("importance"), "selected")


ATTRIBUTION = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg(abs(w * ({c} - m))), 6) AS contribution
    FROM v_ord, (SELECT avg({c}) AS m, (avg({c}) FILTER (target = 1) - avg({c}) FILTER (target = 0)) / var_pop({c}) AS w FROM v_ord)"""
    for c in ["o_totalprice", "c_acctbal"]
)


@query("linear_attribution", f"WITH {V_ORD} {ATTRIBUTION}")
def linear_attribution(spark, sf_dir):
    """Contributions under the weights of a diagonal linear discriminant."""
    names = ["o_totalprice", "c_acctbal"]
    orders = orders_view(spark, sf_dir, lines=False)
    one, zero = F.col("target") == 1, F.col("target") == 0
    fitted = orders.agg(*[
        ((F.avg(F.when(one, F.col(c))) - F.avg(F.when(zero, F.col(c)))) / F.var_pop(c)).alias(c) for c in names
    ]).first()
    frame = orders.select(F.array(*names).alias("vec"))
    return explain.linear_attribution(frame, names, list(fitted)).select("feature", *rounded("contribution"))


@query("permutation_importance", f"""
WITH {V_FRAME},
r AS (SELECT key, row_number() OVER (ORDER BY {u_sql('key', "'permute'")}, key) AS r, count(*) OVER () AS n FROM filled),
lent AS (SELECT a.key, b.key AS lender FROM r a JOIN r b ON b.r % b.n + 1 = a.r),
w AS (SELECT 1e-9 * max(s) AS floor FROM (SELECT j, var_pop(v) AS s FROM x GROUP BY 1)),
s AS (SELECT label AS k, j, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM x GROUP BY 1, 2),
p AS (SELECT k, ln(any_value(n) / sum(any_value(n)) OVER ()) AS prior FROM s GROUP BY 1),
c AS (SELECT x.key, x.label, x.j, s.k, {BAYES_TERM.format(v='x.v')} AS own, {BAYES_TERM.format(v='o.v')} AS other
      FROM x JOIN lent ON lent.key = x.key JOIN x o ON o.key = lent.lender AND o.j = x.j JOIN s ON s.j = x.j, w),
t AS (SELECT key, k, sum(own) AS total FROM c GROUP BY 1, 2),
l AS (SELECT c.key, c.label, c.j AS feature, c.k, prior + total - own + other AS l FROM c JOIN t ON t.key = c.key AND t.k = c.k JOIN p ON p.k = c.k
      UNION ALL SELECT DISTINCT c.key, c.label, '(none)', c.k, prior + total FROM c JOIN t ON t.key = c.key AND t.k = c.k JOIN p ON p.k = c.k),
q AS (SELECT feature, key, any_value(label) AS label, max(l) FILTER (k = 1) > max(l) FILTER (k = 0) AS hit FROM l GROUP BY 1, 2),
f AS (SELECT feature, CASE WHEN count(*) FILTER (hit OR label = 1) = 0 THEN 0 ELSE 2 * count(*) FILTER (hit AND label = 1)
             / (count(*) FILTER (hit) + count(*) FILTER (label = 1)) END AS f1 FROM q GROUP BY 1)
SELECT feature, round(f1, 6) AS f1, round((SELECT f1 FROM f WHERE feature = '(none)') - f1, 6) AS "drop" FROM f WHERE feature <> '(none)'""")
def permutation_importance(spark, sf_dir):
    frame = order_frame(spark, sf_dir)
    predict = models.fit("bayes", frame)
    return explain.permutation_importance(frame, ORD_NUMERIC, predict).select("feature", *rounded("f1", "drop"))


@query("scenario_ablation")
def scenario_ablation(spark, sf_dir):
    candidates = {"logistic": ("logistic", {}), "bayes": ("bayes", {}), "knn": ("knn", {})}
    table = scenario.four_scenarios(document_frame(spark, sf_dir), candidates)
    return table.select("scenario", "model", *rounded("accuracy", "precision", "recall", "f1", "auc"))


@query("scenario_folds")
def scenario_folds(spark, sf_dir):
    candidates = {"logistic": ("logistic", {}), "bayes": ("bayes", {}), "knn": ("knn", {})}
    table = scenario.six_scenarios(
        document_frame(spark, sf_dir), candidates, products=[("n_chars", "n_lines")], ratios=[("n_chars", "n_words")], leak_safe=False,
    )
    return table.select("scenario", "model", "fold", *rounded("accuracy", "f1", "auc"))
