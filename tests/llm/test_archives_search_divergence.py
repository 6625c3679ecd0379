"""WARC archives, lexical search and source divergence against plain versions and on odd rows."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from almsflow.llm import divergence, lexical, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


# WARC

def plain_archives(pages):
    """What the round trip returns: (page, payload bytes, digest, type, refers_to), from (page, url, html) rows."""
    out, owner = [], {}
    for page, _, html in pages:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            owner[payload] = max(owner.get(payload, -1), -1 if page is None else page)
    used = set()
    for page, _, html in sorted(pages, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        first = payload not in owner or ((-1 if page is None else page) == owner[payload] and payload not in used)
        used |= {payload} if first else set()
        held = owner.get(payload)
        out.append((None if page is None else str(page), len(payload), hashlib.sha1(payload).hexdigest(), "response" if first else "revisit",
                    None if first or held == -1 else str(held)))
    return ordered(out)


PAGES = "page_id long, url string, html string"


def page_rows():
    rng = random.Random(3)
    long = "<p>" + "ä word\r\n\r\nand more " * 80
    rows = [(i, f"http://x/{i}", f"<p>{i}" + "a b " * rng.randrange(600)) for i in range(60)]
    rows += [(100 + i, f"http://copy/{i}", long) for i in range(40)]
    rows += [(200, None, None), (201, "", ""), (202, "http://x/\r\nWARC-Type: bad", "short"), (203, "u", "short"), (204, "u", "y" * 999), (205, "u", "y" * 999),
             (206, "u", "z" * 1000), (207, "v", "z" * 1000), (208, "big", "long text " * 300_000), (209, "big2", "long text " * 300_000),
             (139, "again", long), (139, "again", long), (None, "n", long), (None, "n", "q" * 2000), (None, "n2", "q" * 2000)]
    return rows


def test_round_trip_equals_a_plain_version(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES + ", payload string, owner long").repartition(5)
    found = warc.round_trip(pages)
    assert rows_of(found.select("page", "payload_bytes", "payload_digest", "type", "refers_to")) == plain_archives(rows)
    assert found.where("NOT valid OR valid IS NULL").count() == 0
    urls = {r.page: r.url for r in found.collect()}
    assert urls["202"] == "http://x/%0D%0AWARC-Type: bad" and urls["200"] is None
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_every_index_entry_is_a_record_of_its_own(spark, tmp_path):
    rows = page_rows()
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), f"{tmp_path}/streams")
    streams = [p for p in (tmp_path / "streams").glob("*.gz")]
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in streams)
    assert len(streams) > 1 and whole.count(b"WARC/1.1\r\n") == len(rows)
    done = warc.normalise(spark, f"{tmp_path}/streams", f"{tmp_path}/out").collect()
    assert sum(r.records for r in done) == len(rows) and all(r.error is None for r in done)
    by_archive = {}
    for r in warc.index(spark, f"{tmp_path}/out").collect():
        by_archive.setdefault(r.archive, []).append((r.offset, r.length, r.id))
    ids = [x[2] for own in by_archive.values() for x in own]
    assert len(set(ids)) == len(rows)
    for name, own in by_archive.items():
        raw, end = (tmp_path / "out/archives" / name).read_bytes(), 0
        for offset, length, ident in sorted(own):
            assert offset == end
            text = gzip.decompress(raw[offset:offset + length])
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and f"WARC-Record-ID: {ident}\r\n".encode() in text
            end = offset + length
        assert end == len(raw)
    full = warc.read_records(spark, f"{tmp_path}/out")
    payloads = Counter((r.payload for r in full.where("type = 'response'").collect()))
    assert set(payloads) == {(h or "").encode() for _, _, h in rows}


def foreign(kind, body, **named):
    head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, **named, "Content-Length": len(body)}.items())
    return f"WARC/1.0\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def test_foreign_and_damaged_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\r\n\r\nraw"
    digest = "sha1:" + base64.b32encode(hashlib.sha1(b"\x00\xff\r\n\r\nraw").digest()).decode()
    named = {"WARC-Record-ID": "<urn:1>", "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": digest}
    one, two = foreign("response", body, **named), foreign("resource", b"z" * 700_000, **{"WARC-Record-ID": "<urn:2>"})
    info, wrong = foreign("warcinfo", b""), foreign("response", body, **{**named, "WARC-Payload-Digest": "sha1:00"})
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "whole.warc.gz").write_bytes(gzip.compress(info + one + two))
    (folder / "members.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    noise = foreign("resource", random.Random(1).randbytes(200_000))
    cut = gzip.compress(one + noise)
    (folder / "cut.warc.gz").write_bytes(cut[:len(cut) // 2])
    (folder / "wrong.warc.gz").write_bytes(gzip.compress(wrong))
    (folder / "none.gz").write_bytes(gzip.compress(b"no archive\r\n\r\n"))
    (folder / "noise.gz").write_bytes(b"no gzip at all")
    done = {r.source.rsplit("/", 1)[-1]: r for r in warc.normalise(spark, str(folder), f"{tmp_path}/out").collect()}
    assert {k: r.records for k, r in done.items()} == {"whole.warc.gz": 3, "members.warc.gz": 2, "cut.warc.gz": 1, "wrong.warc.gz": 1, "none.gz": 0, "noise.gz": 0}
    assert {k for k, r in done.items() if r.error} == {"cut.warc.gz", "none.gz", "noise.gz"}
    found = warc.read_records(spark, f"{tmp_path}/out").collect()
    assert Counter((r.type, r.valid) for r in found) == {("response", True): 3, ("response", False): 1, ("resource", None): 2, ("warcinfo", None): 1}
    assert {r.payload for r in found if r.type == "response"} == {b"\x00\xff\r\n\r\nraw"}


@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
def test_inflating_in_pieces(piece, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", piece)
    stream = warc.Inflated(io.BytesIO(gzip.compress(b"\r\nhead\r\n\r\nbody") + gzip.compress(b"\r\n\r\nnext\r\n\r\n")))
    assert stream.skip_breaks() and stream.up_to(b"\r\n\r\n", 100) == b"head\r\n\r\n"
    assert b"".join(stream.pieces(4)) == b"body"
    assert stream.skip_breaks() and stream.up_to(b"\r\n\r\n", 100) == b"next\r\n\r\n" and not stream.skip_breaks()


# Lexical search

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_ranks(docs, queries, k):
    found = [(i, Counter(words(t))) for i, t in docs]
    total, length = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in dict.fromkeys(queries):
        scored = []
        for i, c in found:
            m = 10 + 90 * sum(c.values()) * total // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) if t in c)
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return ordered(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = ["w%d" % int(200 * rng.random() ** 3) for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 60, 300])))) for i in range(400)]
    rows += [(500 + i, "W1 w2, w3! über w1") for i in range(15)]  # ties
    rows += [(600, None), (601, ""), (602, " .,"), (603, "w1 " * 60_000), (None, "w1 w2 w3"), (None, "w5"), (500, "W1 w2, w3! über w1"), (604, "a very 42 long9 w7")]
    return rows


@pytest.fixture(scope="module")
def asked():
    rng = random.Random(9)
    return [(i, " ".join(f"w{rng.randrange(150)}" for _ in range(rng.choice([1, 4, 30])))) for i in range(25)] + \
        [(30, None), (31, "..."), (32, "unknown words"), (33, "ÜBER über W3"), (33, "W3 über"), (34, "w1 w2"), (34, "w1 w2"), (None, "w5 42")]


@pytest.mark.parametrize("leaf,chunk,max_terms", [(48, 8192, 32_768), (2, 37, 60), (1, 3, 20)])
def test_ranks_equal_a_full_scan(spark, texts, asked, monkeypatch, leaf, chunk, max_terms):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "CHUNK_DOCS", chunk)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, n int, terms string").repartition(3)
    queries = spark.createDataFrame([(i, t, 0) for i, t in asked], "item_id long, text string, query int")
    found = lexical.rank(docs, queries, 10, max_terms=max_terms)
    assert rows_of(found) == plain_ranks(texts, [q for q in asked if q[1] is not None], 10)


def test_no_documents_or_queries(spark, texts, asked):
    docs, queries = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    for found in (lexical.rank(docs.limit(0), queries), lexical.rank(docs, queries.limit(0)), lexical.rank(docs, queries.where("item_id = 31"))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_bounds_hold_and_prune():
    """No row below a node exceeds the node's bound; most rows of separated topics are never scored."""
    rng = np.random.default_rng(5)
    topics, per, own = 12, 300, 40
    rows = [np.sort(rng.choice(own, 12, replace=False)) + own * (i % topics) for i in range(topics * per)]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms, impacts = np.concatenate(rows), rng.integers(1, 1_000_000, at[-1])
    weights = rng.integers(1, 20_000, topics * own)
    chunk = lexical.Chunk(np.arange(len(rows)), np.zeros(len(rows), bool), at, terms, impacts, weights)
    tree, exact = chunk.tree, np.zeros(len(weights), np.int64)
    scored = 0
    for topic in range(topics):
        asked = np.arange(own * topic, own * topic + 10)
        exact[:] = 0
        exact[asked] = weights[asked]
        scores = np.add.reduceat(exact[chunk.terms] * chunk.impacts, tree.starts[:-1])
        bounds = tree.bounds(asked, np.sqrt(weights[asked].astype(float)))
        for node in range(len(tree.first)):
            assert scores[tree.first[node]:tree.last[node]].max() <= bounds[node]
        best = lexical.Best(5)
        scored += chunk.search(asked, weights[asked].astype(float), exact, best)
        assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:5]
    assert scored < 0.5 * topics * len(rows)


# Divergence

def plain_audit(rows, min_docs):
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER)))) for _, t, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t in df if df[t] >= min_docs)
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            counts[s].update({t: n for t, n in c.items() if df[t] >= min_docs})
        whole = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:50], 1)]
    return ordered(out)


@pytest.mark.parametrize("tile,terms,held", [(64, 16_384, 2_000_000), (2, 8, 100), (1, 1, 1)])
def test_audit_equals_a_plain_version(spark, monkeypatch, tile, terms, held):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "HELD", held)
    rng = random.Random(6)
    some = ["alpha", "Beta", "γάμμα", "delta", "épsilon", "zeta9x", "ETA", "theta-iota", "日本語", "x"] + [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    rows = []
    for i in range(260):
        source, lang = f"s{rng.randrange(5)}", rng.choice(["en", "fr", "de"])
        text = " ".join(rng.choice(some[rng.randrange(8):]) for _ in range(rng.choice([1, 5, 40])))
        rows.append((i, text, lang, source, 0))
    rows += [(300, None, None, None, 0), (301, "alpha", None, "", 0), (302, "", "en", "only empty", 0), (303, "rare", "xx", "a", 0), (304, None, "xx", "b", 0),
             (305, "alone", "yy", "a", 0), (306, "alpha " * 200_000, "en", "very long", 0), (None, "alpha beta", "en", None, 0), (307, "123 456", "fr", "no letters", 0)]
    rows += [(308, "copy of alpha", "de", "copies", 0)] * 12
    docs = spark.createDataFrame([(*r, 1, "v") for r in rows], DOCS + ", count int, terms string").repartition(4)
    found = divergence.audit(docs, min_docs=10)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows_of(found) == plain_audit(rows, 10)


def test_audit_without_kept_terms(spark):
    rows = [(1, "a b", "en", "s", 3), (2, "c", "en", "t", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    assert rows_of(divergence.audit(docs)) == plain_audit(rows, 30) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0
    repeated = [(1, f"{i % 7} 12", "en", f"s{i % 3}", 3) for i in range(100)]  # many documents, no letter in any
    assert rows_of(divergence.audit(spark.createDataFrame(repeated, DOCS))) == plain_audit(repeated, 30)


def test_shares_are_exact_beyond_a_long(spark):
    from pyspark.sql import functions as F

    counts = [0, 1, 10**12, 9 * 10**15]
    got = spark.createDataFrame([(c, 10**16 + 7, 123_457) for c in counts], "c long, n long, v long").select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert [r.p for r in got.collect()] == [1 + 10**9 * (c + 5) // (10**16 + 7 + 5 * 123_457) for c in counts]


def test_terms_of_a_column():
    import pyarrow as pa

    texts = ["One two", "three", None, "", "x", "ÄB3c-d  ", " ", "9"]
    want = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for t in texts]
    assert divergence.terms(pa.array(texts)).to_pylist() == want
    assert divergence.terms(pa.array(texts).slice(1, 5)).to_pylist() == want[1:6]
    assert divergence.terms(pa.array([], pa.string())).to_pylist() == [] and divergence.terms(pa.array([None, ""], pa.string())).to_pylist() == [[], []]
