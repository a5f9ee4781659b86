"""Ranked search against a plain score of every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from driftline.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    count, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in bags:
            m = 75 + (25 * n * count) // total
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in words(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **args):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in lexical.search(d, b, **args).collect()), key=str)


def fixture(seed, docs=120, items=15):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a"] * 8 + [f"w{i}" for i in range(60)] + ["São", "naïve", "x_y", "3,5", "東京"]
    def text(n):
        return "".join(rng.choice(vocabulary).title() + rng.choice([" ", "-", "\n", "_", "'"]) for _ in range(n))
    return ([(i, text(rng.choice([0, 1, 5, 40, 200]))) for i in range(docs)],
            [(100 + i, "the of a " + text(rng.choice([2, 8, 30]))) for i in range(items)])


@pytest.mark.parametrize("args", [{}, {"top": 3}, {"block_terms": 40}])
def test_against_all_scores(spark, args):
    docs, items = fixture(1)
    docs += [(7, docs[3][1]), (None, docs[4][1]), (None, "w1 w2"), (500, None), (501, ""), (502, "- . !"), *docs[:5]]
    items += [items[0], (100, "w1 w2 w1"), (None, "the w5"), (900, None), (901, ""), (902, "nowhere to be found")]
    got = run(spark, docs, items, **args)
    assert got == brute(docs, items, args.get("top", 20))


def test_slices_and_parts_do_not_change_the_rows(spark, monkeypatch):
    docs, items = fixture(2)
    texts = [t for _, t in docs]
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(docs))), "text": texts})
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({w for _, x in items for w in words(x)}))}
    bags = [{t.encode(): q for t, q in Counter(words(x)).items()} for _, x in items]
    plan = lexical.graph(bags, dict.fromkeys(vocabulary, 5))

    def rows():
        counted = list(lexical.count_terms([batch], vocabulary))
        return [b.to_pydict() for b in lexical.best_documents(counted, plan, vocabulary, 100, 5000, 7)]

    whole = rows()
    monkeypatch.setattr(lexical, "SLICE_CELLS", 600)
    monkeypatch.setattr(lexical, "PART_BYTES", 10)
    assert rows() == whole and whole


def test_graph_stands_for_the_items():
    rng = random.Random(3)
    common = [[f"s{k}{i}".encode() for i in range(rng.randint(2, 9))] for k in range(6)]
    bags = []
    for _ in range(60):
        bag = {t: 1 for k in rng.sample(range(6), 3) for t in common[k]}
        bag |= {f"own{rng.randrange(40)}".encode(): rng.randint(1, 3) for _ in range(5)}
        bags.append(bag)
    bags += [bags[0], {}, {b"zero": 2}]
    weight = {t: len(t) for x in bags for t in x} | {b"zero": 0}
    plan = lexical.graph(bags, weight)

    def leaves(node):
        if node < len(plan.leaves):
            return Counter([plan.leaves[node]])
        a, b = plan.pairs[node - len(plan.leaves)]
        return leaves(a) + leaves(b)

    for bag, nodes in zip(bags, plan.items, strict=True):
        assert sum((leaves(n) for n in nodes), Counter()) == Counter((t, q * weight[t]) for t, q in bag.items() if weight[t])
    adds = len(plan.pairs) + sum(max(0, len(x) - 1) for x in plan.items)
    assert adds * 2 < sum(len(x) for x in bags) and plan.items[0] == plan.items[60]


def test_hot_term_long_text_and_empty_tables(spark):
    docs = [(i, "same words in all of them") for i in range(300)] + [(1000, "rare " + "same " * 300_000 + "x" * 100_000)]
    items = [(1, "same rare"), (2, "them words")]
    assert run(spark, docs, items) == brute(docs, items, 20)
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [], []) == []


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, "a b", 2, "t", 3)], "doc_id bigint, text string, score bigint, terms string, n int")
    b = spark.createDataFrame([(5, "b c", "d")], "item_id bigint, text string, doc_id string")
    assert [r.doc_id for r in lexical.search(d, b).collect()] == [r[2] for r in brute([(1, "a b")], [(5, "b c")], 20)]
