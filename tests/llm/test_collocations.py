"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import pytest

from driftline.llm.collocations import collocations


def brute(rows, least, top, longest=5):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, of in f.items():
        found = []
        for p, a in of.items():
            if len(p) < 2 or a < least:
                continue
            if any(of[q] >= a for q in of if len(q) > len(p) and of[q] >= least
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string").repartition(3)


def random_rows(seed, docs=60):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "São", "paulo", "a-b", "x"] + [f"w{i}" for i in range(12)]
    phrases = ["New York City", "on the other hand side", "of the", "São\tPaulo", "a a a a a a a"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", "  ", ", ", ".", "\n", "\r\n", "\x0b", "! ", ":"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize("known", [1_000_000, 10, 0])
@pytest.mark.parametrize("least,top,longest", [(3, 2000, 5), (6, 7, 4), (2, 50, 2)])
def test_against_all_phrases(spark, known, least, top, longest):
    rows = random_rows(least) + [("en", None), ("en", ""), ("fr", "!!"), (None, "one two")]
    got = sorted(tuple(r) for r in collocations(table(spark, rows), least=least, top=top, longest=longest, known=known).collect())
    assert got == brute(rows, least, top, longest) and got


def test_parts_of_a_task_add_up(spark, monkeypatch):
    from driftline.llm import collocations as module
    batches = []
    import pyarrow as pa
    rows = random_rows(5, 80)
    for i in range(0, 80, 10):
        batches.append(pa.RecordBatch.from_pydict({"lang": [x or "und" for x, _ in rows[i:i + 10]], "text": [t for _, t in rows[i:i + 10]]}))
    words = {x: sorted({w for b in batches for lang, data in module._runs([b]) if lang == x for w in data.decode().split()}) for x in ("en", "de", "und")}

    def total(**limits):
        for name, value in limits.items():
            monkeypatch.setattr(module, name, value)
        out = Counter()
        for part in (module.count_words(batches), module.count_windows(batches, [2, 3], words, None)):
            for b in part:
                for r in b.to_pylist():
                    out[r["lang"], r["phrase"]] += r["c"]
        known, twos, threes, salts = module.Numbering(words), Counter(), Counter(), set()
        often = module.np.arange(known.size - 1)
        for b in module.count_triples(batches, words, often, known.size / 2):
            for pair, salt, third, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                (lang,), (phrase,) = (x for x in known.phrases(module.np.array([pair]), 2))
                twos[lang, phrase.as_py()] += c
                salts.add((salt > 0, min(divmod(pair, known.size)) > known.size / 2))
                if third is not None:
                    (lang,), (phrase,) = (x for x in known.phrases(module.np.array([pair * known.size + third]), 3))
                    threes[lang, phrase.as_py()] += c
        assert salts == {(False, False), (True, True)}
        assert twos == Counter({k: c for k, c in out.items() if k[1].count(" ") == 1})
        assert threes == Counter({k: c for k, c in out.items() if k[1].count(" ") == 2})
        return out

    assert total() == total(RUN_BYTES=50, HELD_ROWS=20, HELD_TRIPLES=20) and len(total()) > 100


def test_salted_pairs_add_up(spark, monkeypatch):
    from driftline.llm import collocations as module
    rows = random_rows(9)
    monkeypatch.setattr(module, "partitions", lambda spark: 10**9)   # every pair is salted
    assert sorted(tuple(r) for r in collocations(table(spark, rows), least=4).collect()) == brute(rows, 4, 2000)


def test_exact_beyond_64_bits(spark):
    """1000 a n passes 64 bits only in large tables: the expression is tried alone."""
    df = spark.sql("SELECT cast(3000000000 as bigint) a, cast(90000000000000 as bigint) n, cast(4000000007 as bigint) l, cast(5000000003 as bigint) r")
    w = "decimal(19,0)"
    got = df.selectExpr(f"(cast(1000 as decimal(4,0)) * (cast(a as {w}) * cast(n as {w}))) div (cast(l as {w}) * cast(r as {w})) as s").first().s
    assert got == 1000 * 3000000000 * 90000000000000 // (4000000007 * 5000000003)


def test_hot_rows_and_clashing_columns(spark):
    rows = [("en", "same old story again and again")] * 90 + [("en", "new story")] * 5
    df = spark.createDataFrame([(t, x, 1, "p", 2.0) for x, t in rows], "text string, lang string, k int, phrase string, f double")
    got = [tuple(r) for r in collocations(df, least=5).collect()]
    assert sorted(got) == brute(rows, 5, 2000)
    assert collocations(df.limit(0)).count() == 0


def test_long_text(spark):
    rows = [("en", "alpha beta gamma " * 50_000), ("en", "x" * 100_000)]
    got = sorted(tuple(r) for r in collocations(table(spark, rows), least=100).collect())
    assert got == brute(rows, 100, 2000) and len(got) > 1
