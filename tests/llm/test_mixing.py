from tessella.llm import mixing

DOCS = "doc_id long, text string, source string, skey string, size long, weight double, bucket int, key string"
TARGETS = "source string, target_share double, max_repeats int, total string"


def docs(spark):
    rows = [(i, "x" * (10 + i % 7), ["Big-One ", "big.one", "BIG_ONE"][i % 3]) for i in range(600)]
    rows += [(1000 + i, "y" * 10, "small") for i in range(20)] + [(2000 + i, "z█" * 5, "mid") for i in range(60)]
    rows += [(3000, None, "small"), (3001, "w" * 500, None), (3002, "w" * 500, "other"), (3003, "", "small")]
    return spark.createDataFrame([(*r, "k", 1, 1.0, 1, "k") for r in rows], DOCS)


def targets(spark):
    return spark.createDataFrame([("big_one", 0.5, 1, "t"), ("small", 0.25, 4, "t"), ("mid", 0.2, 3, "t"), ("ghost", 0.05, 2, "t"), (None, 0.0, 1, "t"), ("null share", None, None, "t")], TARGETS)


def test_shares(spark):
    d, t = docs(spark), targets(spark)
    plan = {r.source: r for r in mixing.budgets(d, t).collect()}
    total = plan["mid"].total
    assert total == sum(10 + i % 7 for i in range(600)) + 200 + 60 * 20
    used = {r.source: r for r in mixing.share_report(d, t).collect()}
    assert used["small"].capped and used["small"].used == 4 * 200 and used["small"].most_repeats == 4
    assert used["ghost"].capped and used["ghost"].used == 0
    assert not used["big_one"].capped and 0 <= 0.5 * total - used["big_one"].used < 20
    assert not used["mid"].capped and 0 <= 0.2 * total - used["mid"].used < 20
    assert {r.source for r in mixing.capped_sources(d, t).collect()} == {"small", "ghost"}
    again = sorted(map(tuple, mixing.mix(d, t).collect()))
    assert again == sorted(map(tuple, mixing.mix(d.repartition(5), t).collect()))
    assert again != sorted(map(tuple, mixing.mix(d, t, seed=3).collect()))
    assert max(r[3] for r in again) <= 4


def test_epochs_come_first(spark):
    d = docs(spark)
    t = spark.createDataFrame([("small", 0.6, 9, "t"), ("mid", 0.4, 9, "t")], TARGETS)
    got = [r.repeats for r in mixing.mix(d, t).where("source = 'small'").collect()]
    assert max(got) - min(got) <= 1 and min(got) >= 4


def test_empty(spark):
    d, t = docs(spark), targets(spark)
    assert mixing.mix(d.where("false"), t).count() == 0
    assert mixing.share_report(d.where("false"), t).count() == 6
    assert mixing.share_report(d, t.where("false")).count() == 0


def test_buckets_of_low_weights(spark, monkeypatch):
    """Many buckets, most documents of low weight: the rest is still filled in key order, to the last document."""
    monkeypatch.setattr(mixing, "PER_BUCKET", 20)
    docs = spark.createDataFrame([(i, ("█" * 60 if i % 3 else "x" * 60) + "x" * (i % 7), "s") for i in range(600)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("s", 0.4, 2)], "source string, target_share double, max_repeats int")
    listed = mixing.listed_documents(docs, targets)
    got = {r.doc_id for r in mixing.mix(docs, targets).collect()}
    rows = listed.collect()
    assert 0 < len(got) < 600
    sizes, total = {r.doc_id: r.size for r in rows}, sum(r.size for r in rows)
    u = {r.doc_id: r.u for r in listed.selectExpr("doc_id", "(pmod(xxhash64(17, doc_id), bigint(4503599627370496)) + 1) / double(4503599627370497) AS u").collect()}
    import math

    order, run = sorted(rows, key=lambda r: (-math.log(u[r.doc_id]) / r.weight, r.doc_id)), 0
    want = set()
    for r in order:
        run += sizes[r.doc_id]
        if run <= 0.4 * total:
            want.add(r.doc_id)
    assert got == want
