"""The forest on a small frame, with few trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.operators import forest as rf
from tidemark.plans import study as st
from tidemark.plans import warehouse as wh
from tidemark.sources import writers as wr

FEW = {"trees": 12, "max_depth": 4}
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def study(spark):
    inputs = st.study_inputs(wh.events(spark, FOLDER), wh.companies(spark, FOLDER), wh.prices(spark, FOLDER),
                             wh.market(spark, FOLDER))
    return st.run_study(inputs, **FEW)


def test_study_results(study):
    assert study.summary.count() == 1 and study.ols.n == study.summary.first().n
    assert study.windows.count() == 4 * study.per_event.count()
    scores = rf.cv_metrics(study.forest_folds).first()
    assert scores.n_obs == study.ols.n and 0 < scores.pos_rate < 1
    assert 0.3 < scores.cv_accuracy_mean < 0.7 and 0.3 < scores.cv_roc_auc_mean < 0.7


def test_importance(study):
    rows = rf.feature_importance(study.forest).collect()
    assert sum(r.importance_mean for r in rows) == pytest.approx(1.0)
    assert set(ft.FOREST_NUMERICS) <= {r.feature for r in rows} and all(r.importance_std >= 0 for r in rows)


def test_outputs(spark, study, tmp_path):
    folder = str(tmp_path / "out")
    wr.write_study(folder, summary=study.summary, coefficients=study.ols.table(), diagnostics=study.ols.diagnostics(),
                   importance=rf.feature_importance(study.forest), metrics=rf.cv_metrics(study.forest_folds),
                   per_event=study.per_event, timeline=study.timeline, model=study.forest)
    assert spark.read.json(f"{folder}/analysis_summary").count() == 1
    assert spark.read.option("header", True).csv(f"{folder}/regression_coefficients").count() == len(study.ols.terms)
    again = rf.Forest.load(spark, f"{folder}/rf_model")
    rows = rf.sign_label(study.features, "car_m5_p5")
    score = lambda m: {r.event_id: r.probability for r in m.transform(rows).collect()}
    assert again.trees == FEW["trees"] and score(again) == pytest.approx(score(study.forest))


def test_unseen_category_is_all_zeros(spark):
    schema = "industry_top15 string, stage_clean string"
    model = rf.encoder().fit(spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y")], schema))
    row = model.transform(spark.createDataFrame([("zz", "y")], schema)).first()
    assert list(row.industry_top15_hot.toArray()) == [0, 0, 0] and list(row.stage_clean_hot.toArray()) == [0, 1]


def test_weights_and_folds(spark):
    df = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(32)], "i int, label double")
    weights = {r.label: r.weight for r in rf.class_weights(df).collect()}
    assert weights == {1.0: pytest.approx(32 / (2 * 11)), 0.0: pytest.approx(32 / (2 * 21))}
    folds = rf.stratified_folds(df, ["i"]).groupBy("label", "fold").agg(
        F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("label", "fold").collect()
    # the label of the first row is dealt first: 11 rows, then 21 rows from where those ended
    assert [r.n for r in folds] == [4, 5, 4, 4, 4, 3, 2, 2, 2, 2]
    assert [sum(r.n for r in folds if r.fold == k) for k in range(5)] == [7, 7, 6, 6, 6]
    for label in (0.0, 1.0):
        edges = [(r.lo, r.hi) for r in folds if r.label == label]
        assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_folds_differ_by_one_row_at_most(spark):
    df = spark.createDataFrame([(i, float(i % 3 == 1)) for i in range(32)], "i int, label double")  # 21 rows of the first label, 11 of the other
    sizes = [r["count"] for r in rf.stratified_folds(df, ["i"]).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [7, 7, 6, 6, 6]


def grown(nodes):
    """Nodes of all trees as nested tuples, wherever they were grown."""
    at = {(r.tree, r.top, r.node): r for r in nodes.collect()}

    def below(tree, top, node):
        if (tree, top, -1) in at and node == 0:
            r = at[tree, top, -1]
            return ("leaf", round(r.p, 9)) if r.feature < 0 else (r.feature, r.cut, below(tree, r.left, 0), below(tree, r.right, 0))
        r = at[tree, top, node]
        return ("leaf", round(r.p, 9)) if r.feature < 0 else (r.feature, r.cut, below(tree, top, r.left), below(tree, top, r.right))

    return {tree: below(tree, 1, 0) for tree in {r.tree for r in at.values()}}


def noisy(spark, n, columns=4):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, columns)).round(1)
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(float)
    rows = [(*map(float, r), "ab"[i % 2], float(v)) for i, (r, v) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(columns)]
    return names, rf.with_weights(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", c string, label double"))


def test_one_tree_equals_a_plain_recursive_one(spark):
    names, df = noisy(spark, 300)
    forest = rf.grow_forest(df, names, ["c"], trees=3, max_depth=3)
    rows = rf._coded(df, forest.coder).toPandas()
    codes = np.frombuffer(b"".join(map(bytes, rows["codes"])), np.uint8).reshape(len(rows), -1)
    ids = rows["row"].to_numpy().view(np.uint64)

    def plain(tree, order_of, mine, w, y, level, node):
        one, total = (w * y)[mine].sum(), w[mine].sum()
        leaf = ("leaf", round(one / total, 9))
        if level == 3 or one == 0 or (w * y)[mine].min() > 0:
            return leaf
        gini = lambda r: ((w * y)[r].sum() ** 2 + (w * (1 - y))[r].sum() ** 2) / w[r].sum()
        order = order_of(node)
        for k in range(0, 6, 2):
            cuts = [(round(gini(mine[codes[mine, f] <= c]) + gini(mine[codes[mine, f] > c]) - gini(mine), 9), -i, -int(c), int(f))
                    for i, f in enumerate(order[k:k + 2]) for c in np.unique(codes[mine, f])[:-1]]
            if cuts:
                _, _, c, f = max(cuts)
                return f, -c, mine[codes[mine, f] <= -c], mine[codes[mine, f] > -c]
        return leaf

    got = grown(forest.nodes)
    for tree in range(3):
        times = rf._times(ids, rf.SEED, tree)
        w, y = times * rows["weight"].to_numpy(), rows["one"].to_numpy()
        root = plain(tree, lambda node: rf._order_of_columns(6, rf.SEED, tree, 1, np.array([node]))[0], np.flatnonzero(times > 0), w, y, 0, 0)
        assert got[tree][:2] == root[:2]
        for side, mine, node in ((got[tree][2], root[2], 1), (got[tree][3], root[3], 2)):
            child = plain(tree, lambda n: rf._order_of_columns(6, rf.SEED, tree, 1, np.array([n]))[0], mine, w, y, 1, node)
            assert side[:2] == child[:2]


def test_leaves_are_pure_without_a_depth(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), float(a * b > 0)) for a, b in rng.normal(size=(400, 2))]
    df = rf.with_weights(spark.createDataFrame(rows, "a double, b double, label double"))
    forest = rf.grow_forest(df, ["a", "b"], [], trees=5, group=2)
    leaves = forest.nodes.where("feature < 0").select("tree", "p").collect()
    assert {r.tree for r in leaves} == set(range(5)) and all(r.p in (0.0, 1.0) for r in leaves)
    scored = forest.transform(df)
    assert scored.where("prediction = label").count() > 380


@pytest.mark.parametrize("local_rows", [60, 5000])
def test_large_nodes_are_split_across_tasks(spark, local_rows):
    """Small tasks change who splits a node, and by which drawn columns, but neither counts nor quality."""
    names, df = noisy(spark, 3000)
    forest = rf.grow_forest(df.repartition(5), names, ["c"], trees=4, local_rows=local_rows)
    large = forest.nodes.where("node < 0").count()
    assert (large > 20) == (local_rows == 60)
    scored = forest.transform(df)
    assert scored.count() == 3000 and 0.75 < scored.where("prediction = label").count() / 3000 < 1
    assert sum(r.importance_mean for r in rf.feature_importance(forest).collect()) == pytest.approx(1.0)
    # every row of a tree ends in one leaf
    rows = rf._coded(df, forest.coder)
    ids = np.array([r.row for r in rows.select("row").collect()]).view(np.uint64)
    assert all((rf._times(ids, rf.SEED, t) > 0).mean() == pytest.approx(1 - np.exp(-1), abs=0.03) for t in range(4))


def test_rows_that_are_alike_make_a_large_leaf(spark):
    df = rf.with_weights(spark.range(400).selectExpr("1.0D as a", "'k' as c", "double(id % 4 = 0) as label"))
    forest = rf.grow_forest(df, ["a"], ["c"], trees=3, local_rows=50)
    assert forest.nodes.where("node >= 0").count() == 0 and forest.nodes.count() == 3
    assert all(0.3 < r.probability < 0.7 for r in forest.transform(df).collect())


def test_nulls_and_unknown_categories_are_scored(spark):
    names, df = noisy(spark, 200)
    forest = rf.grow_forest(df, names, ["c"], trees=4, max_depth=5)
    odd = spark.createDataFrame([(None, float("nan"), 1e9, -1e9, "never seen"), (None, None, None, None, None)],
                                ", ".join(f"{c} double" for c in names) + ", c string")
    assert all(0 <= r.probability <= 1 for r in forest.transform(odd).collect())
    assert forest.transform(odd.where("x0 > 0")).count() == 0


def test_forest_needs_two_classes(spark):
    df = spark.createDataFrame([(float(i), 0.5) for i in range(40)], "x double, car double")
    assert rf.fit_forest(df, "car") is None
    assert rf.fit_forest(df.limit(10), "car") is None


def test_forest_learns_an_obvious_sign(spark):
    rng = np.random.default_rng(0)
    rows = [(*[float(v) for v in rng.normal(size=len(ft.FOREST_NUMERICS))], "a", "b") for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in ft.FOREST_NUMERICS)
                               + ", industry_top15 string, stage_clean string")
    df = df.withColumn("car", F.col("log_employees_laid_off"))
    model = rf.fit_forest(df, "car", **FEW)
    top = rf.feature_importance(model).orderBy(F.desc("importance_mean")).first()
    assert top.feature == "log_employees_laid_off"


def test_order_of_rows_does_not_change_a_tree():
    """Sums are exact, so gains that tie do so in any order; rows of 40 steps, 3 flags and a noisy label."""
    rng = np.random.default_rng(3)
    codes = np.column_stack([rng.integers(0, 40, (20000, 3)), rng.integers(0, 2, (20000, 3))]).astype(np.uint8)
    kind = (2 * rng.integers(1, 4, 20000) + rng.integers(0, 2, 20000)).astype(np.uint8)
    first = rf._grow(codes, kind, [0.99568012, 1.00435753], 1, 0, 1, None)
    order = rng.permutation(20000)
    again = rf._grow(codes[order], kind[order], [0.99568012, 1.00435753], 1, 0, 1, None)
    assert all(np.array_equal(first[c], again[c]) for c in first) and len(first["p"]) > 1000


def test_rows_travel_as_their_codes_and_a_byte(spark):
    names, df = noisy(spark, 500)
    coder = rf.fit_coder(df, names, ["c"])
    blocks = rf._blocks(rf._coded(df, coder), 6, [0, 1], rf.SEED, {}, set()).toPandas()
    assert sum(len(v) for c in ("codes", "kind") for v in blocks[c]) < 1000 * 0.7 * 7
    assert set(blocks.columns) == {"tree", "top", "codes", "kind"}


def test_a_label_has_one_weight(spark):
    names, df = noisy(spark, 100)
    with pytest.raises(ValueError, match="one weight"):
        rf.grow_forest(df.withColumn("weight", F.rand(1)), names, ["c"], trees=1)


def test_trees_of_a_block_share_its_rows(spark, monkeypatch):
    """Rows travel once a block, not once a tree, and the nodes are those of trees that are grown one by one."""
    names, df = noisy(spark, 600)
    coder = rf.fit_coder(df, names, ["c"])
    coded, trees = rf._coded(df.repartition(3), coder), list(range(40))
    dealt = []
    spread = type(coded).repartitionById
    monkeypatch.setattr(type(coded), "repartitionById", lambda self, *args: dealt.append(self.cache()) or spread(dealt[-1], *args))
    together = rf._whole_trees(coded, [1.0, 1.0], 6, trees, rf.SEED, None).collect()
    blocks = -(-40 // min(8, max(1, 40 // (2 * spark.sparkContext.defaultParallelism))))
    assert sum(len(r.codes) for r in dealt[0].collect()) == 600 * 6 * blocks
    alone = rf._nodes(rf._blocks(coded, 6, trees, rf.SEED, {}, set()), 4, [1.0, 1.0], 6, rf.SEED, None).collect()
    assert set(together) == set(alone) and len(together) == len(alone) > 40 * 50


def test_of_two_children_one_is_added_up(monkeypatch):
    """The sums of all open nodes are as if each was added up; fewer than half of the rows are, below the root."""
    rng = np.random.default_rng(5)
    codes = np.column_stack([rng.integers(0, 40, 5000), rng.integers(0, 2, (5000, 7))]).astype(np.uint8)
    kind = (2 * rng.integers(1, 4, 5000) + rng.integers(0, 2, 5000)).astype(np.uint8)
    added, there, plain, derived = [], [], rf._Level.flag_sums, rf._Level.child_sums

    def child_sums(level, above, open_):
        there.append(level.counts.sum())
        sums = derived(level, above, open_)
        assert np.array_equal(sums, plain(level, open_))
        return sums

    monkeypatch.setattr(rf._Level, "child_sums", child_sums)
    monkeypatch.setattr(rf._Level, "flag_sums", lambda level, nodes: added.append(level.counts[nodes].sum()) or plain(level, nodes))
    rf._grow(codes, kind, [1.0, 1.0], 1, 0, 1, 6)
    assert len(there) > 3 and added[0] == 5000 and sum(added[1:]) <= 0.5 * sum(there)


def test_scoring_holds_a_few_blocks_of_trees_at_a_time(spark, monkeypatch):
    """Votes are added up in rounds, each of which leaves a sum a row; the shares are those of the trees walked one by one."""
    names, df = noisy(spark, 120)
    trees = 8 * (max(8, 3 * spark.sparkContext.defaultParallelism) + 1)
    forest = rf.grow_forest(df, names, ["c"], trees=trees, max_depth=2)
    rows = df.withColumn("row", F.monotonically_increasing_id()).cache()
    held, settled = [], rf.settled
    monkeypatch.setattr(rf, "_TRAVEL", 0)  # rounds as small as the cluster allows
    monkeypatch.setattr(rf, "settled", lambda d, *path: held.append(settled(d, *path)) or held[-1])
    got = {r.row: r.probability for r in forest.probability(rows).collect()}
    assert [set(h.columns) for h in held] == [{"row", "codes"}, {"row", "p"}] and held[1].count() == 120
    tables, codes = grown(forest.nodes), rf._coded(df, forest.coder, None)
    by_row = {r.row: np.frombuffer(bytes(r.codes), np.uint8) for r in codes.collect()}
    hashes = {r.row: r.h for r in rows.select("row", F.xxhash64(*df.columns).alias("h")).collect()}

    def walk(node, code):
        return node[1] if node[0] == "leaf" else walk(node[2 if code[node[0]] <= node[1] else 3], code)

    for row, p in got.items():
        assert p == pytest.approx(sum(walk(t, by_row[hashes[row]]) for t in tables.values()) / trees, abs=1e-6)
    assert len(got) == 120 and len(tables) == trees


def test_many_rows_are_dealt_to_fewer_trees_at_a_time(spark, monkeypatch):
    """Twice as many as there are cores where rows are many; nodes don't depend on that, with large nodes or without."""
    names, df = noisy(spark, 400)
    few = 2 * spark.sparkContext.defaultParallelism
    dealt, blocks, whole = [], rf._blocks, rf._whole_trees
    monkeypatch.setattr(rf, "_blocks", lambda *args: dealt.append(len(args[2])) or blocks(*args))
    monkeypatch.setattr(rf, "_whole_trees", lambda *args: dealt.append(len(args[3])) or whole(*args))
    for local_rows in (100, 5000):
        nodes = []
        for travel in (rf._TRAVEL, 1):
            with monkeypatch.context() as m:
                m.setattr(rf, "_TRAVEL", travel)
                nodes.append(set(rf.grow_forest(df, names, ["c"], trees=few + 1, local_rows=local_rows, max_depth=4).nodes.collect()))
        assert {n for n in dealt if n > 1} == {few + 1, few} and nodes[0] == nodes[1]
        dealt.clear()
