"""The operators on Spark: odd inputs, brute force on small tables, the pipeline."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sigmawatch.llm import apportion, bpe_fst, chat_grammar, context_mixing, iblt, pii_anchors
from sigmawatch.llm import components, simhash_golay, toxicity_fm, url_sweep, vamana

from cases import DOC_SCHEMA, ODD_TEXTS, docs_frame


@pytest.fixture(scope="module")
def odd(spark):
    # Extra columns with names that results use.
    return (docs_frame(spark, ODD_TEXTS).withColumn("score", F.lit("x")).withColumn("fp", F.lit(1))
            .withColumn("size", F.lit(2)).withColumn("n_tokens", F.lit(3)).withColumn("spans", F.lit(4)))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (4, 6), (7, 7), (2, 1)], "u long, v long")
    assert by_id(components.components(edges)) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4)]
    assert components.components(edges.limit(0)).count() == 0


def test_simhash(spark, odd, none):
    got = collections.Counter(tuple(r) for r in simhash_golay.near_duplicates(odd).collect())
    prints = {i: simhash_golay._signed(simhash_golay.fingerprint(t or "")) for i, t in ODD_TEXTS}
    assert sum(got.values()) == len(ODD_TEXTS)
    assert got[(5, prints[5], 1)] == 1 and got[(6, prints[6], 6)] == 2
    assert got[(2, 0, 2)] == got[(3, 0, 2)] == got[(4, 0, 2)] == 1
    assert (None, prints[None], None) in got
    assert simhash_golay.near_duplicates(none).count() == 0
    kept = simhash_golay.deduplicate(odd)
    assert kept.columns == odd.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(
        {1: 1, 2: 1, 6: 1, 7: 1, 8: 1, None: 1})


def test_large_buckets_go_block_against_block(spark):
    rng = np.random.default_rng(1)
    center = 0x0123456789ABCDEF
    fps = sorted({center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (120, 2))})
    frame = spark.createDataFrame([(simhash_golay._signed(f),) for f in fps], "fp long")
    for size in (10, 20_000):
        roots = components.components(simhash_golay.links(frame, 4, bucket_rows=size))
        assert roots.select("root").distinct().count() == 1 and roots.count() == len(fps)


def test_toxicity(spark, odd, none):
    bad, good = "you worthless idiot of them", "a fine day in the town"
    docs = docs_frame(spark, [(i, bad if i % 3 == 0 else f"{good} {i}") for i in range(400)])
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    scored = toxicity_fm.toxicity(docs, labels)
    rows = scored.filter(toxicity_fm.held_out()).collect()
    assert rows and all(r.predicted == int(r.doc_id % 3 == 0) for r in rows)
    odd_rows = toxicity_fm.toxicity(odd, labels).collect()
    assert len(odd_rows) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in odd_rows)
    assert toxicity_fm.toxicity(none, labels).count() == 0
    assert toxicity_fm.toxicity(odd, labels.limit(0)).filter("predicted = 1").count() == 0


def test_pii(spark, odd, none):
    rows = pii_anchors.find(odd.withColumn("text", F.concat("text", F.lit(" a@b.cd")))).collect()
    assert [r.n_email for r in rows] == [0 if t is None else 1 for _, t in ODD_TEXTS]
    assert pii_anchors.find(none).count() == 0
    clean = pii_anchors.redacted(odd)
    assert clean.columns == odd.columns and by_id(clean) == by_id(odd)


def test_bpe(spark, odd, none):
    rows = bpe_fst.round_trip(odd).collect()
    assert all(r.round_trip for r in rows) and len(rows) == len(ODD_TEXTS)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe_fst.encode(none).count() == 0


def test_mix(spark, odd, none):
    rnd = np.random.default_rng(4)
    docs = docs_frame(spark, [(i, "w " * int(n), s) for i, (n, s) in enumerate(zip(
        rnd.integers(0, 300, 900), rnd.choice(["a", "b", "c", "d", None], 900, p=[.05, .2, .3, .3, .15]), strict=True))])
    rows = apportion.mix(docs, block=8, shard_words=20_000).collect()
    sizes, taken, targets = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    capped: dict = {}
    while True:  # brute force: cap and reshare until none is above
        free = {s: w for s, w in weights.items() if s not in capped}
        rest = sum(sizes.values()) - sum(capped.values())
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    want = capped | share
    for s in weights:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) < 0.02 * want[s] + 40
    again = apportion.mix(docs.repartition(7), block=8, shard_words=20_000)
    assert by_id(again) == sorted((tuple(r) for r in rows), key=repr)
    assert apportion.mix(odd).count() == len(ODD_TEXTS)
    assert apportion.mix(none).count() == 0
    assert apportion.mixed(odd).columns == odd.columns


def test_fitting_rows_are_bounded_when_ids_repeat(spark, monkeypatch):
    import zlib
    # One id with a third of the rows (copies) and one with many texts.
    rows = [(i, f"word{i} text") for i in range(40)] + [(50, "the same text")] * 40 + [(61, f"other {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(40), 50, 61]], "doc_id long, toxic int")
    counts = {}
    for most in (25, 1000):
        # The machine tells how many rows it was fitted on.
        monkeypatch.setattr(toxicity_fm, "fit", lambda r, y, *a: toxicity_fm.Machine(
            float(len(r)), np.zeros(0, np.int32), np.zeros(0, np.float32),
            np.zeros((0, toxicity_fm.FACTORS), np.float32), toxicity_fm.BUCKETS))
        counts[most] = toxicity_fm.train(docs, labels, most).bias
    held = {i for i in [*range(40), 50, 61] if zlib.crc32(str(i).encode()) % 4 == 2}
    whole = len({r for r in rows if r[0] not in held})
    assert counts == {25: 25.0, 1000: float(whole)}


def test_mix_takes_small_sources(spark):
    sizes = [("a", 100, 60), ("b", 8, 1), ("c", 13, 5), ("d", 1, 1), ("e", 3, 4), ("f", 50, 40)]
    docs = docs_frame(spark, [(100 * k + i, "w " * n, s) for k, (s, n, many) in enumerate(sizes) for i in range(many)])
    taken, targets = collections.Counter(), {}
    for r in apportion.mix(docs).collect():
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1 + 0.02 * target, s
    assert {r.source for r in apportion.mixed(docs).select("source").distinct().collect()} == set("abcdef")


def test_url_sweep_equals_its_oracle_sql(spark, tmp):
    import duckdb
    from sigmawatch.llm.queries import ORACLE_SQL, op2_url_sweep
    urls = ["http://EXAMPLE.com/en/x?q", "https://www.example.com/en/", "a://b.www.example.com/en/#f", "x.net/es/",
            "http://x.net/es/a", "http://net/fr/", "http://example.com./en/", "http://notexample.com/en/",
            "http://com", "http://com/", "no scheme", "", None, "://", "http://\u00c9.com/en/", "h://a.net/ES/",
            "http://x.net?/es/", "h://x.net/a://b.com/", "h://a\nb.com/\n/x"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, urls[0]), (3, urls[0]), (3, urls[0])]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp}/pages.parquet")
    for sf_dir, files in ((tmp, f"{tmp}/pages.parquet/*.parquet"),
                          ("/root/testdata/sf0.01", "/root/testdata/sf0.01/pages.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{files}')")
        want = collections.Counter(con.execute(ORACLE_SQL["op2_url_sweep"]).fetchall())
        assert collections.Counter(tuple(r) for r in op2_url_sweep(spark, sf_dir).collect()) == want


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, None, "</turn>"), (2, 0, "assistant", "x\\"),
            (None, 0, "user", "lost"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    turns = chat_grammar.with_trap(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat_grammar.read_back(chat_grammar.format_turns(turns)).collect()}
    want = {1: [("user", "hi"), ("assistant", "")], 2: [("assistant", "x\\"), ("", "</turn>")],
            None: [("user", "lost")], 3: [("assistant", "same")] * 2,
            -7: [("user", chat_grammar.TRAP), ("assistant", chat_grammar.TRAP)]}
    assert got.keys() == want.keys()
    for c, said in want.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars) == (len(said), len(loss))
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_grammar.read_back(chat_grammar.format_turns(turns.limit(0))).count() == 0


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/1", "http://example.com/en", "http://a.net/es/2?q", "http://example.org/",
            None, "no scheme", "http://", "http://com/x", "http://xcom/x", "http://net#/es/", "http://a.net/es/2?q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    for rows in (1, 50_000):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
               for r in url_sweep.judge(pages, url_sweep.default_rules(spark), block_rows=rows).collect()}
        assert got == {0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
                       1: ("example.com", "/en", "com/", "allow"), 2: ("a.net", "/es/2", "net/es/", "block"),
                       3: ("example.org", "/", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
                       6: ("", "", None, "allow"), 7: ("com", "/x", "com/", "allow"), 8: ("xcom", "/x", None, "allow"),
                       9: ("net", "", None, "allow"), 10: ("a.net", "/es/2", "net/es/", "block")}
    assert url_sweep.judge(pages.limit(0), url_sweep.default_rules(spark)).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).round(3)
    x[50:90] = x[40]  # ties
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    rows += [(500, None, 0), (520, [0.0] * 8, 0), (540, [float("nan")] * 8, 0), (None, [1.0] * 8, 0), (560, [1.0] * 3, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = collections.defaultdict(list)
    for r in sorted(vamana.nearest(frame, shard_rows=150, query_block=7).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 400, 20))
    hits = 0
    for q, found in got.items():
        scores = x @ x[q]
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        hits += len({i for i, _ in found} & {i for _, i in want})
        assert len(found) == 20 and all(s == pytest.approx(scores[i]) for i, s in found)
    assert hits / (20 * len(got)) > 0.95
    assert [i for i, _ in got[40]][:3] == [50, 51, 52] or got[40][0][1] > got[40][1][1] - 1e-9
    assert vamana.nearest(frame.limit(0)).count() == 0


def _vectors(kind, n=2400, dims=32):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, dims))
    if kind == "gaussian":
        return x
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind.startswith("lognormal"):
        x *= np.exp(float(kind.split()[1]) * rng.normal(size=n))[:, None]
    if kind == "outlier":
        x[7] *= 10_000
    return x * {"huge": 1e20, "tiny": 1e-25, "largest": 1e300}.get(kind, 1.0)


@pytest.mark.parametrize("kind", ["unit", "gaussian", "lognormal 0.1", "lognormal 0.3", "lognormal 0.5",
                                  "lognormal 1.0", "outlier", "huge", "tiny", "largest"])
def test_recall_whatever_the_norms(spark, kind):
    """Over several shards, against all rows."""
    x = _vectors(kind)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in vamana.nearest(frame, shard_rows=1000).collect():
        got[r["query_id"]].add(r["vec_id"])
    if kind == "largest":  # every score is infinite, so none is nearer than another
        assert all(len(g) == 20 for g in got.values()) and len(got) == len(x) // 20
        return
    scale = x / np.abs(x).max()  # the same order, without overflow
    hits = 0
    for q in range(0, len(x), 20):
        scores = scale @ scale[q]
        scores[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-scores, kind="stable")[:20].tolist()))
    assert hits / (20 * len(got)) >= 0.9 and len(got) == len(x) // 20, hits


def test_sketches(spark, none):
    rows = [r for r in ODD_TEXTS if r[0] not in (8,)] + [(9, "First. Second one!\nThird.\nThird.\n" + " ".join(
        f"Sentence {i}." for i in range(400))), (10, "Third. Second one! " + "x\ny\n" * 50)]
    docs = docs_frame(spark, rows).withColumn("cell", F.lit(1))
    order = sorted({i for i, _ in rows if i is not None}) + [None]
    first = {i: min(t or "" for j, t in rows if j == i) for i in order}
    nxt = {i: first[order[(k + 1) % len(order)]] for k, i in enumerate(order)}

    def units(t):
        return set(collections.Counter(p for p in re.split(r"\n+|(?<=[.!?])[ \t]+", t) if p).items())

    def like(a, b):
        return 1.0 if not a | b else len(a & b) / len(a | b)

    got = iblt.fingerprints(docs).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for i, t in rows:
        t = t or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[i][:half]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(units(t), units(edited)), 9),
              round(like(units(t), units(nxt[i])), 9))] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                               for r in got) == want
    prints = collections.defaultdict(set)
    for r in got:
        prints[r.doc_id].add(r.fingerprint)
    assert prints[1] == prints[5] != prints[9] and prints[2] == prints[3]
    assert iblt.fingerprints(none).count() == 0


def test_language_model(spark, odd, none):
    got = context_mixing.language_model(odd).collect()
    train = [t or "" for i, t in ODD_TEXTS if i is None or not held(i)]
    counts = collections.Counter(w for t in train for w in t.encode().lower().split())
    total, distinct = sum(counts.values()) + len(train), len(counts) + 1
    texts = {i: t or "" for i, t in ODD_TEXTS}
    assert len(got) == len(ODD_TEXTS)
    for r in got:
        w = texts[r.doc_id].encode().lower().split()
        base = sum(np.log10((c + 1) / (total + distinct + 1)) for c in [*(counts[x] for x in w), len(train)])
        assert r.base_score == pytest.approx(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(w) + 1, sum(x in counts for x in w) + 1)
        assert r.score < 0
        size = len(texts[r.doc_id].encode()) + 1
        assert r.bits_per_byte == pytest.approx(-r.score * np.log2(10) / size)
    assert context_mixing.language_model(none).count() == 0


def test_language_model_is_fitted_on_whole_texts_of_a_growing_sample(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, " ".join(words[(i + j) % 4] for j in range(300)) + f" end{i}") for i in range(1500)]
    rows += [(7777, "the same text again")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chosen, others, tasks = context_mixing.fit_sample(docs, fit_rows=5)
    got = chosen.collect()
    # One in 32, however few rows a task has; whole texts; with the others every row once.
    texts = collections.Counter(r["text"] for r in got)
    fresh = {t: n for t, n in texts.items() if t != "the same text again"}
    assert 25 <= len(fresh) <= 75 and tasks == round(1800 / 32 / 5)
    assert texts + collections.Counter(r["text"] for r in others.collect()) == collections.Counter(t for _, t in rows)
    assert all(t.split()[-1].startswith("end") for t in fresh)
    assert {r["_task"] for r in got} <= set(range(tasks))
    model = context_mixing.train(docs, fit_rows=5)
    assert np.isfinite(model.weights).all() and np.isfinite(model.refine).all()
    assert (model.weights != np.float32(0.25)).any()


def test_language_model_is_fitted_on_every_training_text(spark, monkeypatch):
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, " ".join(words[(i + j) % 4] for j in range(i % 40)) + f" end{i}") for i in range(400)]
    rows += [(7777, "the same text again")] * 300 + [(None, None), (None, "no id"), (8888, "")]
    kept, write = {}, context_mixing.materialise

    def keep(df, purpose):
        kept[purpose] = write(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(context_mixing, "materialise", keep)
    model = context_mixing.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), fit_rows=5)
    texts = [context_mixing.fold(t or "") for _, t in rows]
    want = 0
    tables = [np.zeros((2, 1 << b), np.int64) for b in context_mixing.SLOT_BITS]
    for data, fresh, _, behind in context_mixing.runs(*context_mixing.joined(texts)):
        want += model.code.length[context_mixing.pairs(data, fresh, behind)].sum()
        context_mixing.contexts(data, fresh, behind)
    context_mixing.add_texts(tables, texts, model.code)
    passed = sum(np.frombuffer(r["passed"], np.float64).sum() for r in kept["cm-fitted"].collect())
    assert passed == want
    for got, counts in zip(model.tables, tables, strict=True):
        assert (got == context_mixing.entries(*counts)).all()
    # Each half is fitted against the other half's counts alone.
    ours, whole = np.zeros((2, 1 << 16), np.int64), tables[0]
    half = [r["half"] for r in context_mixing.halved(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert 0 < sum(half) < len(rows)
    mine = [t for t, h in zip(texts, half, strict=True) if h == 0]
    for data, fresh, _, behind in context_mixing.runs(*context_mixing.joined(mine)):
        _, bit, slots, _, _ = context_mixing.decisions(data, fresh, model.code, behind)
        np.add.at(ours, (bit, slots[0]), 1)
    block = next(r for r in kept["cm-tables"].collect() if (r["kind"], r["block"]) == (0, 0))
    size = 1 << context_mixing.BLOCK_BITS
    others = np.frombuffer(block["others"], np.int16).reshape(2, size)
    assert (others[0] == context_mixing.entries(*(whole - ours)[:, :size])).all()
    assert (others[1] == context_mixing.entries(*ours[:, :size])).all()


def held(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_pipeline_stages(spark):
    """Each stage against its definition, on the smallest tables."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert out.columns == names, name
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
        assert set(after) <= set(before)
        if name == "simhash":
            prints = {i: simhash_golay.fingerprint(t or "") for i, t in before.items()}
            kept = [prints[i] for i in after]
            assert len(after) == out.count()
            assert all((a ^ b).bit_count() > 4 for k, a in enumerate(kept) for b in kept[:k])
        if name == "pii":
            find = pii_anchors.Finder()
            assert after == {i: t and pii_anchors.redact(t, find(t)) for i, t in before.items()}
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()


def test_near_copies_keep_distinct_texts_of_one_id(spark):
    """An id with two unrelated texts and a copy of one under another id: both texts stay."""
    one, two = "the quick brown fox jumps over a lazy dog", "nothing here is like the other text at all"
    docs = docs_frame(spark, [(5, one), (5, two), (9, one), (9, one), (None, two), (None, "a third text of its own")])
    kept = collections.Counter((r.doc_id, r.text) for r in simhash_golay.deduplicate(docs).collect())
    assert kept == {(5, one): 1, (5, two): 1, (None, "a third text of its own"): 1}


def test_pipeline_stages_on_odd_rows(spark, odd, none):
    """Nulls, repeated and empty rows, columns named like results or like helpers of a stage."""
    sf_dir = "/root/testdata/sf0.001"
    clashing = odd
    for name in ("predicted", "_i", "_row", "_clean", "_copies", "_text", "_near_id", "ids"):
        clashing = clashing.withColumn(name, F.lit("kept"))
    clashing = corpus_pipeline.materialise(clashing, "test-odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, sf_dir)
        assert out.columns == clashing.columns, name
        rows = out.collect()
        assert rows and all(r.score == "x" and r._i == r._clean == r.predicted == "kept" for r in rows), name
        assert stage(spark, none, sf_dir).collect() == [], name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, clashing, sf_dir).count() == clashing.count()
    assert last(spark, none, sf_dir).count() == 0
