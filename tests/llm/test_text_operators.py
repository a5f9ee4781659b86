"""Small tests of the operators that SQL cannot express, against brute force, the
tokenizers' own libraries, and the awkward rows: nulls, empty and long texts, ties,
repeated rows, empty tables, and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftline.llm import arc, bpe, neardup, omh, quality, secrets, sharding, substring, token_counts, words

BPE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "password = abcdefgh12 " + "lorem ipsum dolor " * 20_000
AWKWARD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, LONG), (6, "same text here"), (6, "same text here"),
           (None, "no id here"), (8, "ünïcödé – 文字 \U0001f600 token: 'é abc12345678'")]


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows with names that operators use themselves."""
    rows = [(i, t, "x", 0, "y") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, secrets string, N int, score string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


# --- secret scan -----------------------------------------------------------------

BASE = {
    "assign": (re.compile(r"(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_key", "apikey"))
        + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(1)) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 32),
}


def base_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, (rule, keep)) in enumerate(BASE.items())
             for m in rule.finditer(text) if keep(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


PIECES = ["password", "Secret", "toKEN", "api_key", "APIKEY", "passwd", "=", ":", " ", '"', "'", "abc", "AKIA", "AKIAB1C2",
          "0a1b2c3d" * 2, "deadbeef" * 4, "é", "\n", "X9", "==", "-", "/", "ſecret", "ghp_", "文"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_base_rules_match_a_backtracking_search(text):
    got = secrets.automaton().spans(text.encode())
    assert [s for s in got if s[0] in BASE] == base_spans(text)


def test_format_rules_add_spans():
    text = "ghp_" + "a" * 36 + " AIza" + "b" * 35 + " -----BEGIN RSA PRIVATE KEY----- ghp_short"
    kinds = [k for k, *_ in secrets.automaton().spans(text.encode()) if k not in BASE]
    assert kinds == ["github", "google", "pem"]


def test_key_blocks_are_spans_to_their_end():
    body = "\n".join(["MIIEpAIBAAKCAQEA+b/" + "Ab1/" * 11] * 5) + "\nQ==\n"
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    extra = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n"
    for block in (begin + "\n" + body + end, begin + extra + body + end, begin + "\\n" + body.replace("\n", "\\n") + end,
                  begin + "\r\n" + body.replace("\n", "\r\n") + end, begin):
        text = "é " + block + ", then. " + begin + " cut: " + block
        spans = [s for s in secrets.automaton().spans(text.encode()) if s[0] == "pem"]
        assert [text[s:e] for _, s, e in spans] == [block, begin, block]


def test_minimised_automaton_has_no_equal_states():
    dfa = secrets.automaton().search
    rows = {(tuple(dfa.table[i * dfa.width:(i + 1) * dfa.width]), a) for i, a in enumerate(dfa.accepts)}
    assert len(rows) == len(dfa.accepts)


def test_scan_and_redact_awkward_rows(awkward):
    got = secrets.scan_documents(awkward).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert [tuple(s) for s in r.secrets if s["kind"] in BASE] == base_spans(r.text or "")
    clean = secrets.redact(awkward).collect()
    assert sum(r.text is None for r in clean) == 1
    assert all(not base_spans(r.text) for r in clean if r.text)
    assert [r.text for r in clean if r.doc_id == 6] == ["same text here"] * 2


# --- quality ----------------------------------------------------------------------

def _plain_features(text, buckets):
    """Every feature of a text, one by one."""
    out, words = [], text.split()
    for w in words:
        codes = [zlib.crc32(w)]
        marked = b"<" + w + b">"
        for n in quality.GRAMS:
            for i in range(len(marked) - n + 1):
                h = n
                for c in marked[i:i + n]:
                    h = (h * int(quality.BASE) + c + 1) % 2**64
                codes.append(h)
        for h in codes:
            h = h * int(quality.BASE) % 2**64
            h = (h ^ h >> 32) * int(quality.BASE) % 2**64
            out.append((h >> 40) % buckets)
    for d in quality.REPEATS:
        out += [quality.repeat_bucket(d, buckets)] * sum(a == b for a, b in zip(words, words[d:]))
    return out


def test_scores_are_plain_averages_and_softmax():
    rng = np.random.default_rng(5)
    buckets = 997
    model = quality.Model(rng.normal(scale=9, size=buckets), 0.3)
    texts = [b"", b"a", b"one two two one", "é \u4e2d\u6587 x".encode(), b"again again again", b"w" * 100 + b" tail", b" \t\n", b"a b " * 500]
    got = quality.Scorer(model).scores(texts) + quality.Scorer(model).scores(texts[::-1])[::-1]
    for text, score, again in zip(texts, got[:len(texts)], got[len(texts):], strict=True):
        feats = _plain_features(text, buckets)
        logits = (0.0, model.bias + (sum(model.weights[f] for f in feats) / len(feats) if feats else 0.0))
        assert score == again == pytest.approx(math.exp(logits[1]) / (math.exp(logits[0]) + math.exp(logits[1])), rel=1e-9)
        ids, shares = quality.text_features(text, buckets)
        assert dict(zip(ids.tolist(), shares.tolist(), strict=True)) == pytest.approx({f: feats.count(f) / len(feats) for f in feats})


def test_the_sample_is_bounded_in_rows_and_features(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "train", lambda rows, settings: taken.append(rows) or quality.Model(np.zeros(4), 0.0))
    ids = a, b, c, d = [i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    docs = spark.createDataFrame([(a, "same text")] * 3000 + [(a, "other text"), (b, "a b c"), (c, "d " * 5000), (d, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(a, 1), (b, 0), (c, 1), (d, 0), (a, 1)], "doc_id bigint, quality int")
    quality.fit(docs, labels)
    assert len(taken[-1]) == len(ids)
    quality.fit(docs, labels, quality.Settings(max_rows=1))
    assert len(taken[-1]) == 1
    quality.fit(docs, labels, quality.Settings(max_features=0))
    assert all(len(features) == 0 for features, *_ in taken[-1])


def test_classifier_learns_and_is_held_out(spark):
    rng = random.Random(1)
    vocabulary = ["river", "stone", "garden", "letter", "window", "morning", "paper", "silver"]
    rows = [(i, " ".join(rng.choice(vocabulary) + ("" if i % 2 else "&&&") for _ in range(rng.randint(3, 40))), i % 2)
            for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    got = quality.score_documents(docs, model).withColumn("out", quality.held_out(F.col("doc_id"))).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) >= 0.95
    swapped = spark.createDataFrame([(r.doc_id, 1 - truth[r.doc_id]) for r in held] + [
        (i, y) for i, y in truth.items() if i not in {r.doc_id for r in held}], "doc_id bigint, quality int")
    assert np.array_equal(quality.fit(docs, swapped).weights, model.weights)  # held-out labels are never seen


def test_classifier_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, 1), (6, 0), (None, 1), (4, None)], "doc_id bigint, quality int")
    model = quality.fit(awkward, labels)
    got = quality.score_documents(awkward, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3]
    none = quality.fit(empty, labels)
    assert none.bias == 0 and quality.score_documents(empty, none).count() == 0


# --- byte-level BPE and token counts ------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import base64

    import tiktoken
    with open(BPE_PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TOKEN_PIECES = ["a", "b", " ", "  ", "\n", "\t", "é", "\x1c", "\x85", "1", "!", "'s", "'", "the", "ing", "Ω", "日本", "́",
                "\xa0", ".", "aaaa", " ", "K", "<|endoftext|>", "<|startoftext|>"]


def test_encoding_matches_the_library(library):
    rng = random.Random(2)
    texts = ["".join(rng.choice(TOKEN_PIECES) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["ab" * 20_000, "x" * 5000, LONG, ""]
    ours = bpe.vocabulary(BPE_PATH, public_tokenizers.PATTERN)
    ids = ours.encode(texts)
    assert all(a.tolist() == library.encode_ordinary(t) for a, t in zip(ids, texts, strict=True))
    assert all(ours.decode(a.tolist()) == t.encode() for a, t in zip(ids, texts, strict=True))


def test_rank_queue_gives_lowest_rank_leftmost():
    rng = random.Random(3)
    queue, wanted = bpe.RankQueue(50_000), []
    for _ in range(3000):
        rank, at = rng.randrange(50_000) if rng.random() < .5 else rng.randrange(40), rng.randrange(10**6)
        queue.push(rank, at)
        wanted.append((rank, at))
    got = []
    while (rank := queue.lowest()) >= 0:
        got += [(rank, at) for at in queue.take(rank)]
    assert got == sorted(wanted)


def test_round_trip_of_awkward_rows(awkward, empty):
    coded = bpe.encode_documents(awkward, BPE_PATH, public_tokenizers.PATTERN, out_col="N")
    got = coded.select("text", F.col("N").alias("ids"), bpe.id_digest(F.col("N")).alias("sha"),
                       bpe.decode(F.col("N"), BPE_PATH, public_tokenizers.PATTERN).alias("back")).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert bytes(r.back) == (r.text or "").encode()
        assert r.sha == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(empty, BPE_PATH, public_tokenizers.PATTERN).count() == 0


def test_counts_match_the_library(awkward, empty):
    rng = random.Random(4)
    counter = token_counts.counter(WORD_PATH)
    texts = ["".join(rng.choice(TOKEN_PIECES) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    wanted = [len(e.ids) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts([t.encode() for t in texts]) == wanted
    got = token_counts.count_documents(awkward, WORD_PATH, out_col="score").collect()
    assert all(r.score == len(counter.tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    assert token_counts.count_documents(empty, WORD_PATH).count() == 0


def test_counter_refuses_a_tokenizer_that_keeps_spaces():
    with pytest.raises(ValueError, match="white space"):
        token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))


# --- near duplicates ------------------------------------------------------------------

def _near_brute(rows):
    sets = {i: set(words.shingles((t or "").encode()).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_groups_match_all_pairs(spark):
    """One group of many unequal near copies, whose likeness spans the threshold."""
    rng = random.Random(5)
    source = [f"w{rng.randrange(900)}" for _ in range(160)]
    rows = []
    for i in range(120):
        copy = list(source)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, rows[7][1]) for i in range(30)]
    rows += [(300 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(400, None), (401, ""), (402, "a b"), (403, "A  B"), (404, " ")]
    roots, sizes = _near_brute(rows)
    assert len(set(roots.values())) > 10
    got = neardup.group_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == roots
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_awkward_rows(awkward, empty):
    got = neardup.group_near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.component_id == r.doc_id and r.kept for r in got)
    assert neardup.group_near_duplicates(empty).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = b.replace("b59", "changed")
    for rows, wanted in (
            ([(3, a), (5, a), (5, b), (9, near), (9, ""), (11, c), (12, ""), (None, a)],
             {3: {3}, 5: {3}, 9: {3}, 11: {11}, 12: {12}, None: {None}}),
            ([(5, a), (5, b), (7, near), (7, c)], {5: {5}, 7: {5}})):
        got = neardup.group_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert len(got) == len(rows)
        assert {i: {r.component_id for r in got if r.doc_id == i} for i in wanted} == wanted
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_of_a_long_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a bigint, b bigint")
    got = {r.node: r.root for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 101: 100}


# --- ARC and WARC ------------------------------------------------------------------------

PAGES = [(1, "http://a/ b", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://c", ""), (5, "http://d",
         "x\r\n\r\nWARC/1.1\r\n\r\n\nhttp://e 0.0.0.0 1 t 3\n"), (6, "http://f", "y" * 9_000_000), (2, "http://b", "<p>é</p>"),
         (None, "http://g", "<p>é</p>")]


@pytest.mark.parametrize("version,few", [(1, 50_000), (2, 50_000), (None, 0)])
def test_arc_to_warc_round_trip(spark, tmp_path, monkeypatch, version, few):
    monkeypatch.setattr(arc, "FEW", few)
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(3)
    arcs, warcs = str(tmp_path / "arc"), str(tmp_path / "warc")
    packed = "gzip" if version == 2 else "none"
    arc.write_arc(pages, arcs, "page_id", "url", "html", version=version, compression=packed)
    arc.arc_to_warc(spark, arcs, warcs, key_type="bigint", compression=packed)
    got = arc.read_warc(spark, warcs).collect()
    assert len(got) == len(PAGES) and len({r.record_id for r in got}) == len(PAGES)
    first = {"<p>é</p>": 1, "": 3}
    by_key = {r.key: r for r in got}
    for key, _, html in PAGES:
        r, body = by_key[None if key is None else str(key)], html or ""
        assert (r.payload_bytes, r.payload_digest) == (len(body.encode()), arc.digest(body.encode()))
        revisit = key is not None and first.get(body, key) != key
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to_key == (str(first[body]) if revisit else None)
        assert r.payload == (None if revisit else body.encode())
        assert r.date == "2024-01-01T00:00:00Z" and r.url.isascii() and " " not in r.url


def test_arc_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    arcs, warcs = str(tmp_path / "arc"), str(tmp_path / "warc")
    arc.write_arc(pages, arcs, "page_id", "url", "html")
    arc.arc_to_warc(spark, arcs, warcs)
    assert arc.read_warc(spark, warcs).count() == 0


def test_small_payloads_are_no_revisits(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    arcs, warcs = str(tmp_path / "arc"), str(tmp_path / "warc")
    arc.write_arc(pages, arcs, "page_id", "url", "html")
    arc.arc_to_warc(spark, arcs, warcs, min_bytes=1, key_type="bigint")
    assert {r.key for r in arc.read_warc(spark, warcs).where("record_type = 'revisit'").collect()} == {"2"}


def test_damaged_archives_raise():
    good = arc.arc_archive([("1", "http://a", "body")], "n", 1, "20240101000000").encode()
    assert len(list(arc.convert(good))) == 1
    with pytest.raises(ValueError, match="declares"):
        list(arc.convert(good[:-2]))
    with pytest.raises(ValueError, match="version"):
        list(arc.convert(good.replace(b"\n1 0 ", b"\n3 0 ", 1)))
    with pytest.raises(ValueError, match="fields"):
        list(arc.convert(good.replace(b"http://a 0.0.0.0", b"http://a", 1)))
    record = arc.warc_record(("1", "u", "d", "t", b"HTTP/1.1 200 OK\r\n\r\n", b"body", "<id>", arc.digest(b"other"), 4, None))
    with pytest.raises(ValueError, match="digest"):
        list(arc.read_warc_bytes(record))
    with pytest.raises(ValueError, match="whole"):
        list(arc.read_warc_bytes(record[:-1]))


def _foreign_arc(*records):
    """An ARC 1 file as other writers made them, of (header without length, content)."""
    block = b"1 0 InternetArchive\n" + arc.ARC_FIELDS[1].encode() + b"\n\n"
    parts = [b"filedesc://x.arc 0.0.0.0 19961022035000 text/plain %d\n" % len(block) + block]
    return b"\n".join(parts + [line + b" %d\n" % len(content) + content for line, content in records]) + b"\n"


FOREIGN = [
    (b"http://a/latin 1.2.3.4 19970101120000 text/html", b"HTTP/1.0 200 OK\r\nServer: caf\xe9\r\n\r\n<p>\xe9\xff\x00</p>"),
    (b"http://b/lf 1.2.3.4 19970101120001 text/html", b"HTTP/1.0 200 OK\nContent-Length: 999\n\nbody\r\n\r\nmore"),
    (b"dns:www.a.com 1.2.3.4 199701011200 text/dns", b"19970101120002\nwww.a.com. 100 IN A 1.2.3.4\n"),
    (b"http://c/a b c.html 1.2.3.4 19970101120003 text/html; charset=x", b"HTTP/1.0 404 Not Found\r\n\r\n"),
    (b"http://d/\xe9 1.2.3.4 19970101120004 no-type", b"HTTP/1.0 200 OK\r\nno empty line"),
    (b"http://e/same 1.2.3.4 19970101120005 text/html", b"HTTP/1.0 200 OK\r\nX-Record-Key: 2\r\n\r\n<p>\xe9\xff\x00</p>"),
    (b"http://f/none 1.2.3.4 19970101120006 text/html", b""),
]


@pytest.mark.parametrize("packed", [False, True])
def test_foreign_archives(spark, tmp_path, packed):
    import gzip
    keyed = [(line, content.replace(b"\r\n", b"\r\nX-Record-Key: 1\r\n", 1) if i == 0 else content) for i, (line, content) in enumerate(FOREIGN)]
    data = _foreign_arc(*keyed)
    arcs, warcs = tmp_path / "arc", str(tmp_path / "warc")
    arcs.mkdir()
    # Members of a gzip archive, one per record, as crawlers write them.
    (arcs / "x.arc").write_bytes(gzip.compress(data[:300]) + gzip.compress(data[300:]) if packed else data)
    arc.arc_to_warc(spark, str(arcs), warcs, key_type="bigint")
    got = {r.url: r for r in arc.read_warc(spark, warcs).collect()}
    assert set(got) == {"http://a/latin", "http://b/lf", "dns:www.a.com", "http://c/a%20b%20c.html", "http://d/%C3%A9", "http://e/same", "http://f/none"}
    a, b, dns, c, d, e, f = (got[u] for u in ("http://a/latin", "http://b/lf", "dns:www.a.com", "http://c/a%20b%20c.html", "http://d/%C3%A9", "http://e/same", "http://f/none"))
    assert (bytes(a.payload), a.payload_bytes) == (b"<p>\xe9\xff\x00</p>", 10) and a.payload_digest == arc.digest(bytes(a.payload))
    assert bytes(b.payload) == b"body\r\n\r\nmore" and b.record_type == "response"
    assert (dns.record_type, bytes(dns.payload), dns.date) == ("resource", FOREIGN[2][1], "1997-01-01T12:00:00Z")
    assert bytes(c.payload) == b"" and bytes(d.payload) == b"" and (f.record_type, bytes(f.payload)) == ("resource", b"")
    assert (e.record_type, e.payload, e.payload_bytes, e.refers_to_key) == ("revisit", None, 10, "1")
    records = arc.read_arc(spark, str(arcs)).collect()
    assert {bytes(r.head + r.payload) for r in records} == {content for _, content in keyed}
    assert len({r.record_id for r in records}) == len(FOREIGN)


def test_clashing_columns_of_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x", "k", 5)], "page_id bigint, url string, html string, key string, payload_bytes int")
    arcs = str(tmp_path / "arc")
    arc.write_arc(pages, arcs, "page_id", "url", "html")
    assert [(r.key, bytes(r.payload)) for r in arc.read_arc(spark, arcs).withColumn("salt", F.lit(1)).collect()] == [("1", b"x")]


# --- order MinHash --------------------------------------------------------------------------

def test_numbered_kmers_by_definition():
    text = "abcabcabxabcabcab" * 3
    codes, seen, names = omh.numbered_kmers(text, 4), {}, {}
    for i, code in enumerate(codes.tolist()):
        gram = text[i:i + 4]
        seen[gram] = seen.get(gram, 0) + 1
        names.setdefault((gram, seen[gram]), code)
    assert len(set(codes.tolist())) == len(codes) == len(names)
    again = omh.numbered_kmers(text[:20], 4).tolist()
    assert again == codes.tolist()[:len(again)]  # numbers go by what came before


def test_sketch_by_brute_force():
    text = "the quick brown fox jumps over the lazy dog, the quick brown cat sleeps"
    codes = omh.numbered_kmers(text)
    for j, value in enumerate(omh.sketch(text)):
        odd, seed = int(omh._ODD), int(omh._SEEDS[1 + j])
        ranked = sorted(range(len(codes)), key=lambda i: (int(codes[i]) ^ seed) * odd % 2**64)
        made = 2
        for i in sorted(ranked[:2]):
            made = int(omh._mix(np.array([(made * odd + int(codes[i])) % 2**64], dtype=np.uint64))[0])
        assert value == made >> 32


def test_likeness_falls_with_edits_and_order():
    rng = random.Random(6)
    parts = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(4)]
    text, swapped = "".join(parts), "".join(parts[::-1])
    base = omh.sketch(text)
    near = omh.likeness(base, omh.sketch(text[:600] + "?" + text[600:]))
    assert omh.likeness(base, base) == 1 and near > 0.7
    assert omh.likeness(base, omh.sketch(swapped)) < near
    assert omh.likeness(base, omh.sketch("".join(rng.choice("mnopqr ") for _ in range(1200)))) == 0


@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_next_documents(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 50)))) for i in range(n)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in omh.compare_with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == n
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(text) // 3
        new = text[:len(text) - cut] + after[:cut]
        r = got[key]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == omh.sketch(text).tobytes().hex()
        assert r.near_edited == omh.likeness(omh.sketch(text), omh.sketch(new))
        assert r.near_next == omh.likeness(omh.sketch(text), omh.sketch(after))


def test_next_of_awkward_rows(awkward):
    got = omh.compare_with_next(awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert {r.doc_id: r.n_chars for r in got}[1] == 0


# --- substring dedup and sharding -------------------------------------------------------------

@pytest.mark.parametrize("period", list(substring.COVERS))
def test_covers_align_every_pair(period):
    places = set(substring.COVERS[period])
    for a in range(period):
        for b in range(period):
            assert any((a + d) % period in places and (b + d) % period in places for d in range(period))


def _repeat_brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    count = {}
    for _, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            count[key] = count.get(key, 0) + 1
    out = []
    for i, w in split:
        gone = {k + o for k in range(len(w) - window + 1) if count[tuple(w[k:k + window])] > 1 for o in range(window)}
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [3, 35])
def test_repeats_match_brute_force(spark, window):
    rng = random.Random(window)
    pool = [[f"p{rng.randrange(50)}" for _ in range(rng.randint(window - 1, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(pool) if rng.random() < .5 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 50))]
            text += part[rng.randint(0, 3):]
        rows.append((i, " ".join(text)))
    rows += [rows[3], (3, "other"), (90, None), (91, ""), (92, " \n"), (None, rows[5][1]),
             (93, "echo " * (2 * window)), (94, "x " * (window - 1)), (95, "x y " * window)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id bigint, text string, class string, id int")
    got = sorted((tuple(r) for r in substring.remove_repeats(df, window).collect()), key=str)
    assert got == _repeat_brute(rows, window)


def test_repeats_of_no_rows(empty):
    assert substring.remove_repeats(empty).count() == 0


def test_shared_rows_over_batch_edges():
    import pyarrow as pa
    rows = [(1, 5), (2, 5), (2, 5), (2, 7), (2, 9), (3, 1), (4, 2), (4, 2), (5, 1), (5, 3)]
    wanted = [(2, 5), (2, 7), (2, 9), (5, 1), (5, 3)]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a:a + size]]) for k in (0, 1)],
                                              names=["hash", "class"]) for a in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in substring._shared(1)(iter(batches)) for r in b.to_pylist()]
        assert got == wanted


def _jump(key, shards):
    home, at = -1, 0
    while at < shards:
        home = at
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        at = int((home + 1) * (2**31 / ((key >> 33) + 1)))
    return home


def test_jump_hash_by_its_loop():
    keys = np.array([0, 1, 2, 17, 2**40, -1, -5, 2**63 - 1])
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys.view(np.uint64), shards).tolist() == [_jump(int(k) % 2**64, shards) for k in keys]


def test_shards_slots_and_growth(spark, empty):
    rows = [(i, i % 7) for i in range(900)] + [(None, 1), (None, 2), (5, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, slot int")
    got = sharding.assign(df, 8, ranges=5).withColumn("grown", sharding.shard_of(F.col("doc_id"), 9)).collect()
    assert len(got) == len(rows)
    for shard in range(8):
        mine = sorted((r.slot, -1 if r.doc_id is None else r.doc_id) for r in got if r.shard == shard)
        assert [s for s, _ in mine] == list(range(len(mine)))
        assert [k for _, k in mine] == sorted(k for _, k in mine)
    assert all(r.grown in (r.shard, 8) for r in got)
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.assign(df.repartition(3), 8, ranges=2).collect()}
    assert {(r.doc_id, r.shard) for r in got} == {x[:2] for x in again}
    assert sharding.assign(empty, 8).count() == 0
