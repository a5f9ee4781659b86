"""Registered text queries against DuckDB, decontamination cases, and the pipeline's
stages against a brute-force run on a small fixture."""

import hashlib
import random
import subprocess
import sys
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import ROOT, SF_SMALL
from driftline.llm import decontam, neardup, quality, secrets, words
from driftline.llm.queries import ORACLE_SQL, QUERIES
from scripts.compare_oracle import TABLES, canon


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == canon(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_query_gives_every_document(spark, con, name):
    got = [r.doc_id for r in E.queries()[name](spark, SF_SMALL).select("doc_id").collect()]
    assert sorted(got) == [x for x, in con.sql("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


# --- byte-level BPE ------------------------------------------------------------------------

def test_op5_encodes_each_text_once(spark):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    df = E.queries()["op5_byte_bpe"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == plan.count("both(") == 1
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in df.collect():
        ids = lib.encode_ordinary(texts[r.doc_id])
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- decontamination --------------------------------------------------------------------

def _similarity(a, b):
    def bag(w):
        runs = [tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        return {r: runs.count(r) for r in runs}
    x, y = bag(a), bag(b)
    both = sum(min(n, y.get(k, 0)) for k, n in x.items())
    return both / (sum(x.values()) + sum(y.values()) - both)


def test_leaks_by_all_windows(spark):
    rng = random.Random(8)
    items = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(12, 40))] for _ in range(8)]
    items.append(["again"] * 9 + ["and"] + ["again"] * 9)
    docs = []
    for i in range(60):
        text = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
        if i % 3:
            part = list(rng.choice(items))
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = "changed"
            text[len(text) // 2:len(text) // 2] = part
        docs.append((i, text))
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start, r.n_words) for r in decontam.leaks(
        spark.createDataFrame([(i, " ".join(t).upper()) for i, t in docs], "doc_id bigint, text string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")).collect()}
    wanted = {}
    for i, text in docs:
        for k, item in enumerate(items):
            if len(text) >= 5:
                windows = [(round(_similarity([w.lower() for w in text[max(s, 0):s + len(item)]], item), 9), -max(s, 0))
                           for s in range(4 - len(item) + 1, len(text) - 4)]
                best = max(windows)
                if best[0] >= 0.8:
                    wanted[i, k] = (best[0], -best[1], len(item))
    assert len(wanted) > 10
    assert got == wanted


def test_leaks_of_swapped_parts(spark):
    """The best window lies where no shingle is at its own place within the item."""
    rng = random.Random(18)
    items = [[f"s{k}_{i}" for i in range(n)] for k, n in enumerate((40, 48, 59, 30))]
    docs = []
    for k, item in enumerate(items):
        for cut in (len(item) // 2, len(item) // 3):
            foreign = [f"u{rng.randrange(10**6)}" for _ in range(40)]
            for a, b in ((0, 0), (20, 20), (0, 40), (40, 0)):
                docs.append((len(docs), foreign[:a] + item[cut:] + item[:cut] + foreign[40 - b:]))
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start, r.n_words) for r in decontam.leaks(
        spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id bigint, text string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")).collect()}
    wanted = {}
    for i, text in docs:
        for k, item in enumerate(items):
            best = max((round(_similarity(text[max(s, 0):s + len(item)], item), 9), -max(s, 0))
                       for s in range(5 - len(item), len(text) - 4))
            if best[0] >= 0.8:
                wanted[i, k] = (best[0], -best[1], len(item))
    assert {k for _, k in wanted} == {0, 1, 2} and len(wanted) == 24
    assert got == wanted


def test_simhash_and_blocks(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randrange(-2**63, 2**63) for _ in range(rng.randint(0, 30))]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, s array<bigint>").withColumn("f", decontam.simhash(F.col("s"))) \
        .withColumn("b", decontam.blocks(F.col("f"))).withColumn("s2", F.transform("s", lambda h: F.xxhash64(h, F.lit(2)))) \
        .withColumn("near", decontam.near_blocks(F.col("f")))
    for r in df.collect():
        halves = [sum(1 << b for b in range(64) if sum(1 if h >> b & 1 else -1 for h in s) > 0) for s in (r.s, r.s2)]
        assert [f % 2**64 for f in r.f] == halves
        whole = halves[0] | halves[1] << 64
        assert sum(part["value"] << 16 * part["block"] for part in r.b) == whole and len(r.b) == 8
        assert len(r.near) == len(set(r.near)) == 8 * 697
        assert all((part["value"] ^ whole >> 16 * part["block"] & 0xFFFF).bit_count() <= 3 for part in r.near)


def test_pairs_within_the_radius_meet_and_few_others_do(spark):
    """The index finds all pairs of its radius, measured at a similarity of 0.8, and one
    pair in ten of unrelated ones."""
    rng = random.Random(10)
    rows = []
    for i in range(400):
        s = [rng.randrange(-2**63, 2**63) for _ in range(45)]
        rows.append((i, s, s[:40] + [rng.randrange(-2**63, 2**63) for _ in range(5)]))   # 40 of 50 in common
    df = spark.createDataFrame(rows, "i int, s array<bigint>, t array<bigint>")
    f = df.select("i", decontam.simhash(F.col("s")).alias("f"))
    g = df.select(F.col("i").alias("j"), decontam.simhash(F.col("t")).alias("g"))
    met = f.select("i", F.inline(decontam.blocks(F.col("f")))).join(
        g.select("j", F.inline(decontam.near_blocks(F.col("g")))), ["block", "value"]).select("i", "j").distinct()
    met = {(r.i, r.j) for r in met.collect()}
    both = f.join(g, F.col("i") == F.col("j")).select("i", decontam.distance(F.col("f"), F.col("g")).alias("d")).collect()
    within = {r.i for r in both if r.d <= decontam.RADIUS}
    assert len(within) >= 0.985 * len(rows) and all((i, i) in met for i in within)
    others = sum(i != j for i, j in met) / (len(rows) * (len(rows) - 1))
    assert 0.05 < others < 0.10


def test_short_items(spark):
    rng = random.Random(12)
    vocabulary = ["a", "b", "C", "d", "e"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 20])))) for i in range(60)]
    items = [(0, "c d"), (1, "a"), (2, "e  D\tc"), (3, "b b b b"), (4, "not there"), (5, "c d e a b"), (6, "C D")]
    got = {(r.doc_id, r.item_id): (r.similarity, r.n_words, r.start) for r in decontam.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
        if r.item_id != 5}
    wanted = {}
    for i, text in docs:
        w = text.lower().split()
        for k, item in items:
            v = item.lower().split()
            at = [p for p in range(len(w) - len(v) + 1) if w[p:p + len(v)] == v]
            if at and k != 5:
                wanted[i, k] = (1.0, len(v), at[0])
    assert got == wanted and {k for _, k in wanted} >= {0, 1, 6}


def test_long_item(spark):
    item = [f"w{i}" for i in range(4000)]
    docs = [(1, " ".join(["x"] * 50 + item + ["y"] * 50)), (2, " ".join(item[:3900])), (3, " ".join(item[2000:]))]
    began = time.time()
    got = sorted(tuple(r) for r in decontam.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(
        [(7, " ".join(item)), (8, "w1 w2 w3 w4 w5 w6")], "item_id bigint, text string")).collect() if r.item_id == 7)
    assert got == [(1, 7, 1.0, 4000, 50), (2, 7, 3896 / 3996, 4000, 0)]
    assert time.time() - began < 60   # 181 s with every window compared


def test_leaks_awkward_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, item + " tail"), (5, item + " tail"), (None, "x " + item),
            (6, "two words more"), (7, "lorem " * 50_000 + item)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(10, item), (11, "two  WORDS"), (12, None), (13, "")], "item_id bigint, text string")
    got = sorted((str(r.doc_id), r.item_id, r.similarity) for r in decontam.leaks(docs, bench).collect())
    assert got == [("4", 11, 1.0), ("5", 10, 1.0), ("5", 10, 1.0), ("6", 11, 1.0), ("7", 10, 1.0), ("None", 10, 1.0)]
    left = decontam.without_leaks(spark, docs, bench).collect()
    assert sorted(r.doc_id for r in left) == [1, 2, 3]
    assert decontam.leaks(docs.limit(0), bench).count() == decontam.leaks(docs, bench.limit(0)).count() == 0


# --- pipeline ----------------------------------------------------------------------------

def test_stages_follow_their_input(spark):
    from driftline.llm.common import table
    docs = table(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "neardup", "decontam", "secrets", "bpe"]
    model = quality.fit(docs, table(spark, SF_SMALL, "labels"))
    good = {r.doc_id: r.text for r in quality.score_documents(docs, model).where("score >= 0.5").collect()}
    groups = neardup.group_near_duplicates(docs.where(F.col("doc_id").isin(list(good))), percent=80).collect()
    first = {r.doc_id for r in groups if r.doc_id == r.component_id}
    held = {r.doc_id for r in decontam.leaks(docs, table(spark, SF_SMALL, "benchmark")).collect()}
    wanted = {i: good[i] for i in first - held}
    stage = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, SF_SMALL)
        assert stage.columns == docs.columns
    rows = {r.doc_id: r for r in stage.collect()}
    assert set(rows) == set(wanted) and held and len(good) < docs.count() and len(first) < len(good)
    for i, r in rows.items():
        assert r.n_chars == len(r.text)
        spans = secrets.automaton().spans(wanted[i].encode())
        assert (r.text == wanted[i]) == (not spans)
    last = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(last) == set(rows)
    assert all(r.n_tokens == len(r.ids) for r in last.values())


def test_near_copies_between_the_thresholds(spark):
    """The stage links at 0.8, op3 at 0.85: all pairs, most of them in between."""
    rng = random.Random(6)
    rows = []
    for i in range(60):
        text = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(46, 72))]
        copy = list(text)
        copy[len(copy) // 2] = "changed"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    sets = {i: set(words.shingles(t.encode()).tolist()) for i, t in rows}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert sum(0.8 <= x < 0.85 for x in alike.values()) > 20 and any(0 < x < 0.8 for x in alike.values())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in corpus_pipeline.stage_neardup(spark, docs, SF_SMALL).collect()}
    assert left == set(sets) - {b for (_, b), x in alike.items() if x >= 0.8}
    op3 = {r.doc_id for r in neardup.group_near_duplicates(docs).where("kept").collect()}
    assert op3 == set(sets) - {b for (_, b), x in alike.items() if x >= 0.85}


def test_bands_follow_the_threshold():
    assert neardup.layout(85) == (44, 8) and neardup.layout(80) == (58, 6)
    for percent in (50, 60, 70, 80, 85, 95, 100):
        count, rows = neardup.layout(percent)
        assert count * rows <= neardup.BINS and (1 - (percent / 100) ** rows) ** count <= 1e-6


def test_last_stage_decodes_its_ids(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(["", "Two  words\n", "é文 ſecret 🙂", None, "a" * 5000])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in corpus_pipeline.stage_bpe(spark, docs, SF_SMALL).collect()}
    assert {i: r.decoded_sha256 for i, r in got.items()} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t, *_ in rows}
    assert all(r.n_tokens == len(r.ids) for r in got.values())


def test_pipeline_of_no_documents(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    for name, kind in (("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_imports_without_these_files():
    code = ("import sys; sys.modules['driftline.llm'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q)")
    blocked = code.replace("sys.modules['driftline.llm'] = None", """
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == 'corpus_pipeline' or name.startswith('driftline.llm'):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())""")
    subprocess.run([sys.executable, "-c", blocked], cwd=ROOT, check=True, timeout=100)
