"""Each operator against a plain version, and on nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almsflow.runtime import cut_lineage
from almsflow.llm import decontaminate, fingerprints, htmltext, language, licenses, lines, mixing, neardup, queries, shards, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], SCHEMA)


def prose(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Near and exact copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(4)
    base, passage = prose(rng, 300).split(), prose(rng, 80)
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.choice([0, 2, 4, 8, 12, 30])):
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i * 3, " ".join(words), "xx", "s0"))
    rows += [(200 + i, prose(rng, 60) + " " + passage + "\nCommon line\n" + prose(rng, 20), "yy", f"s{i % 12}") for i in range(24)]
    rows += [(300, None, None, None), (301, "", "xx", ""), (302, " \n\t", "xx", None), (303, "two words", "xx", "s1"), (304, "Two\twords", "xx", "s1"),
             (305, prose(rng, 30_000), "xx", "s2"), (306, "1234 5678", None, "s3"), (None, passage, "yy", "s4"), (None, "no id here", "yy", "s4"),
             (303, "two words", "xx", "s1")]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return table(spark, odd_rows).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def plain_groups(rows, size, percent):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), low.get(find(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(odd, odd_rows, nothing, size, percent):
    found = neardup.near_duplicates(odd, size, percent)
    assert rows_of(found.select("doc_id", "n_shingles", "component_id")) == sorted(plain_groups(odd_rows, size, percent), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert neardup.near_duplicates(nothing).count() == 0
    kept = neardup.drop_near_duplicates(odd, size, percent)
    assert kept.columns == odd.columns
    firsts = {r[2] for r in plain_groups(odd_rows, size, percent) if r[2] is not None}
    assert {r.doc_id for r in kept.collect()} - {None} == firsts
    assert kept.where("doc_id IS NULL").count() == 2


def test_small_comparison_groups_give_the_same_components(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 4)
    assert rows_of(neardup.near_duplicates(odd, 3, 85).select("doc_id", "n_shingles", "component_id")) == \
        sorted(plain_groups(odd_rows, 3, 85), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_likely_similarity_is_near_the_truth():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        both = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, (2000 - len(both)) // 2, dtype=np.uint64)]) for _ in range(2))
        regs = neardup.registers([a, b])
        j = len(both) / (len(a) + len(b) - len(both))
        assert abs(neardup.likely_similarity(regs[:1], regs[1:], np.array([len(a)]), np.array([len(b)]))[0] - j) < 0.15


@pytest.mark.parametrize("group", [2_000, 1])
def test_substrings_equal_a_plain_version(odd, odd_rows, nothing, group):
    last = 1 << 63
    first, docs = {}, [(last if i is None else i, (t or "").encode().split()) for i, t, *_ in odd_rows]
    for i, w in docs:
        for p in range(len(w) - 49):
            k = tuple(w[p:p + 50])
            first[k] = min(first.get(k, i), i)
    want = []
    for i, w in docs:
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p:p + 50])] < i for q in range(p, p + 50)}
        want.append((None if i == last else i, len(w), len(gone), hashlib.sha256(b" ".join(x for q, x in enumerate(w) if q not in gone)).hexdigest()))
    assert rows_of(substrings.repeated_substrings(odd, group=group)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert substrings.repeated_substrings(nothing).count() == 0


def test_long_runs_of_one_word_stay_small():
    slices = [(i, i, 0, b" ".join([b"again"] * 20_000)) for i in range(3)]
    assert substrings.subtree_marks(slices, 50) == [(1, 1, 0, 19_951), (2, 2, 0, 19_951)]


def test_decontamination_spans_parts_and_columns(spark, odd, odd_rows, nothing):
    passage = odd_rows[40][1].split("\n")[0].split()[60:]
    items = [(1, " ".join(passage[:40])), (2, "TWO words"), (3, None), (None, " ".join(passage[20:60])), (2, "..."), (10, " ".join(passage[:13]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows_of(decontaminate.contamination(odd, bench))
    assert whole == rows_of(decontaminate.contamination(odd, bench, max_words=30))  # several automata
    by_id = {r[0]: r for r in whole if r[0] is not None}
    assert by_id[303][1:4] == (2, 2, 1) and by_id[303][4] == hashlib.sha256(b"2").hexdigest() and by_id[303][5]
    assert by_id[300][1:4] == (0, 0, 0) and by_id[300][4] == hashlib.sha256(b"").hexdigest() and not by_id[300][5]
    assert by_id[200][2] == 60 and by_id[200][3] == 3
    text, span = odd_rows[40][1], by_id[200][6][0]
    assert text[span["start"]:span["end"]].split() == passage[:60]
    clash = odd.withColumnsRenamed({"lang": "found", "n_chars": "n_words"})
    kept = decontaminate.drop_contaminated(clash, bench)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r[0] or -1 for r in whole if not r[5])
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.drop_contaminated(odd, bench.limit(0)).count() == odd.count()


def test_language_parse_equals_a_plain_walk():
    texts = {"a": "abcab abcabd", "b": "xyz xyx"}
    model = language.Model(texts)

    def phrases(ref, text):
        n, held = 1, ""
        for c in text:  # a symbol that does not extend the phrase starts the next one, or stands alone if unknown
            if held + c in ref:
                held += c
            else:
                n, held = n + 1, c if c in ref else ""
        return n

    for text in ("abcabd ab", "xyxyz", "ab xyz ab"):
        symbols = model.symbols(text)
        assert model.phrases(symbols, np.array([len(text)]))[0, :2].tolist() == [phrases(texts["a"], text), phrases(texts["b"], text)]


def test_language_letters_beyond_the_table():
    """Languages that differ only in letters which are rare over all samples."""
    rng = random.Random(7)
    common = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0x3B1, 0x3CA))) + "".join(map(chr, range(0x430, 0x450)))
    first, second = "".join(map(chr, range(0x4E00, 0x4E80))), "".join(map(chr, range(0x5200, 0x5280)))
    texts = {"aa": prose(rng, 3000, common), "ja": prose(rng, 300, first), "zh": prose(rng, 300, second)}
    model = language.Model(texts)
    letters = sorted({c for t in texts.values() for c in t if c.isalpha()})
    assert len(letters) > 300 and len({int(model.symbols(c)[0]) for c in letters}) == len(letters)
    asked = [prose(rng, 40, alphabet) for alphabet in (first, second) for _ in range(10)] + ["\u0e01\u0e02", "no \u0e01"]
    assert [model.langs[k] for k in model.costs(asked[:20])[0].argmin(axis=1)] == ["ja"] * 10 + ["zh"] * 10

    def phrases(ref, text):
        n, held = 1, ""
        for c in text:
            if held + c in ref:
                held += c
            else:
                n, held = n + 1, c if c in ref else ""
        return n

    for text in asked:
        found = model.phrases(model.symbols(text), np.array([len(text)]))[0, :3].tolist()
        assert found == [phrases(texts[x], text) for x in model.langs]


def test_language_queries(spark, nothing, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = queries.QUERIES["op10_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert language.identify(nothing).count() == 0
    by_id = {r.doc_id: r for r in language.identify(odd).collect()}
    for i in (300, 301, 302, 306):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert {r.doc_id for r in language.keep_identified(odd).collect()}.isdisjoint({300, 301, 302, 306})


def test_shards(spark, odd, nothing):
    placed = shards.assign(odd, shards.default_dims(), 7)
    rows = placed.collect()
    assert len(rows) == odd.count()
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert rows_of(placed) == rows_of(shards.assign(odd.repartition(3), shards.default_dims(), 7))
    small = table(spark, [(i, "x" * (i % 9), "l", "s") for i in range(500)])
    sizes = {}
    for r in shards.assign(small, shards.default_dims(), 24).collect():
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 5 * 16
    assert shards.assign(nothing, shards.default_dims(), 24).count() == 0
    clash = odd.withColumnRenamed("source", "shard")
    full = shards.with_shards(clash, 5)
    assert full.columns == ["doc_id", "text", "lang", "n_chars", "shard", "slot"] and full.count() == odd.count()
    assert full.where("shard IS NULL OR slot IS NULL").count() == 0


def test_mixing(spark, odd, nothing):
    mix = mixing.plan(odd)
    rows = mixing.report(odd, mix).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert rows_of(mixing.report(odd, mix)) == rows_of(mixing.report(odd.repartition(3), mixing.plan(odd.repartition(2))))
    copies = mixing.mixed(odd, mix)
    assert copies.count() == sum(r.copies for r in rows)
    assert mixing.report(nothing, mixing.plan(nothing)).count() == 0 and mixing.mixed(nothing, mixing.plan(nothing)).count() == 0
    many = table(spark, [(i, "w " * (i % 50), "l", f"s{i % 4}") for i in range(2000)])
    total, goal = {}, {}
    joined = mixing.report(many, mixing.plan(many)).join(many.select("doc_id", "source"), "doc_id").collect()
    for r in joined:
        total[r.source], goal[r.source] = total.get(r.source, 0) + r.taken, r.target
    assert all(abs(total[s] - goal[s]) <= 50 for s in goal)


def test_targets_and_splitting():
    goal = mixing.targets({"a": 10, "b": 1000, None: 0}, {"a": 3.0, "b": 1.0, None: 2.0})
    assert goal == {"a": 30.0, "b": 980.0, None: 0.0}
    quotas = np.array([5, 0, 17, 100])
    assert (mixing.split_quotas(quotas, 6, np.random.default_rng(0)).sum(axis=0) == quotas).all()


def test_fingerprint_parts():
    rng = random.Random(2)
    a, b = prose(rng, 200), prose(rng, 90)
    x, y = fingerprints.PrefixHash("head " + a), fingerprints.PrefixHash(b + a[:500])
    assert fingerprints.longest_common_extension(x, 5, y, len(b)) == 500 + (a[500:501] == "")
    assert fingerprints.spans_equal(x, 5, y, len(b), 500) and not fingerprints.spans_equal(x, 0, y, 0, 5)
    assert fingerprints.fingerprint(a) == fingerprints.fingerprint(a) != fingerprints.fingerprint(b)
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("")) == 1
    assert fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(a + "tail")) > 0.8


def test_spans_between_edits_are_shared(spark):
    rng = random.Random(12)
    text = prose(rng, 400)
    n = len(text)
    both_ends = "A first" + text[20:n - 20] + "the end"
    around = "Put before. " * 5 + text + "; put after" * 5
    swapped = text[n // 2:] + text[:n // 2]
    like = lambda a, b: fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b))
    for other, least in ((both_ends, (n - 40) / n), (around, n / len(around)), (swapped, 0.97), (text[:50] + "?" + text[50:n - 70] + "!" + text[n - 70:], n / (n + 2))):
        assert least - 0.06 <= like(text, other) == like(other, text) <= 1
    assert like(prose(rng, 400, "abcd"), prose(rng, 400, "stuv")) < 0.05
    docs = table(spark, [(1, text, "l", "s"), (2, both_ends, "l", "s"), (3, "", "l", "s")])
    near = {r.doc_id: r.near_next for r in fingerprints.fingerprints(docs, 2).collect()}
    assert near[1] > 0.9 and near[2] == 0 and near[3] == 0


def test_blocks_in_another_order_are_alike():
    rng, found = random.Random(13), []
    for _ in range(300):
        blocks = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(rng.randint(80, 200))) for _ in range(4)]
        one, two = [rng.sample(blocks, 4) + rng.sample(blocks, 4) for _ in range(2)]
        found.append(fingerprints.likeness(*(fingerprints.fingerprint("".join(x)) for x in (one, two))))
    assert sum(found) / len(found) > 0.92 and sorted(found)[15] > 0.85


def test_fingerprints_of_other_levels_are_brought_together():
    rng = random.Random(14)
    short = prose(rng, 300)
    long = prose(rng, 20_000) + short
    fine, coarse = (fingerprints.fingerprint(x) for x in (short, long))
    assert int(fine.split(".")[4]) < int(coarse.split(".")[4])
    assert fingerprints.likeness(fine, fine.replace("0.", "0.", 1)) == 1.0
    half = prose(rng, 6000)
    a, b = half + prose(rng, 500), half + prose(rng, 9000)
    assert abs(fingerprints.likeness(*(fingerprints.fingerprint(x) for x in (a, b))) - len(half) / len(b)) < 0.06
    for odd in ("a" * 100_000, "ab " * 50_000, "\u65e5\u672c" * 3000, "x" * 4096 + "y" * 9000):
        h = fingerprints.PrefixHash(odd)
        level, hashes, sizes, strength = fingerprints._spans(h)
        assert sizes.sum() == len(odd) and sizes.max() <= fingerprints.LONGEST and sum(strength >= level) <= fingerprints.MOST + 1
        assert fingerprints.likeness(fingerprints.fingerprint(odd), fingerprints.fingerprint(odd + "!")) > 0.75
    # A span's hash is that of its text, whatever entries it is put together from.
    packed = fingerprints.fingerprint(long).split(".")
    whole = fingerprints._at_level(packed[5], 16)
    assert len(whole) == 1 and int(whole[0]) >> 32 == int(packed[1][:8], 16) and int(whole[0]) & 0xFFFFFFFF == len(long)


def test_arrays_of_an_edited_text():
    rng = random.Random(15)
    for n, m in ((200, 100), (7, 300), (40, 1), (40, 0), (3, 5), (0, 4)):
        a, b = prose(rng, n)[:n * 4], prose(rng, m)
        tail = len(a) // 4
        made = fingerprints.PrefixHash(a).replaced_tail(len(a) - tail, fingerprints.PrefixHash(b), min(tail, len(b)))
        assert fingerprints.fingerprint(made) == fingerprints.fingerprint(fingerprints.edited(a, b))


@pytest.mark.parametrize("ranges", [1, 4, 200])
def test_fingerprints_follow_the_next_document(odd, odd_rows, nothing, ranges):
    order = sorted(((1 << 63) if i is None else i, t or "") for i, t, *_ in odd_rows)
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed = t[:len(t) - len(t) // 4] + following[:len(t) // 4]
        want.append((None if i == 1 << 63 else i, len(t), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.fingerprint(t)))
    got = fingerprints.fingerprints(odd, ranges)
    assert rows_of(got.select("doc_id", "n_chars", "edited_sha256", "fingerprint")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    rows, following = got.collect(), {}
    for k, (i, t) in enumerate(order):
        following.setdefault((None if i == 1 << 63 else i, fingerprints.fingerprint(t)), []).append(fingerprints.fingerprint(order[(k + 1) % len(order)][1]))
    for r in rows:  # both are functions of fingerprints
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next in [fingerprints.likeness(r.fingerprint, x) for x in following[r.doc_id, r.fingerprint]]
    assert fingerprints.fingerprints(nothing).count() == 0


def test_licenses(spark, nothing):
    mit = ". ".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "as-is")) + "."
    docs = table(spark, [(1, "Intro. Released under the MIT License.\nAll  rights reserved!", "l", "s"), (2, None, "l", "s"), (3, mit, "l", "s"), (4, "no rights", "l", "s"),
                         (5, "Licensed under the Apache License, Version 2.0.", "l", "s")])
    assert [(r.doc_id, r.n_known, r.licenses) for r in licenses.license_scan(docs).orderBy("doc_id").collect()] == \
        [(1, 2, "MIT,All-Rights-Reserved"), (2, 0, ""), (3, 3, "MIT"), (4, 0, ""), (5, 1, "Apache-2.0")]
    assert licenses.license_scan(nothing).count() == 0


MIT_FILE = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
"""
BSD_FILE = """Copyright (c) 2011 A Company
All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of A Company, Inc nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.
"""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version %s of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_wrapped_licenses(spark):
    """Licence files as they are shipped, plain and as comments of several languages."""
    want = [(MIT_FILE, "MIT", 3), (APACHE_HEADER, "Apache-2.0", 3), (" ".join(APACHE_HEADER.split()), "Apache-2.0", 2), (BSD_FILE, "All-Rights-Reserved,BSD-3-Clause", 5),
            (GPL_HEADER % 3, "GPL-3.0-or-later", 2), (GPL_HEADER % 2, "GPL-2.0-or-later", 2)]
    texts, i = [], 0
    for text, _, _ in want:
        for opening in ("", "# ", " * ", "// ", ";; ", "-- "):
            texts.append((i, "x = 1\n\n" + "".join(f"{opening}{x}\n" for x in text.splitlines()), "l", "s"))
            i += 1
    got = licenses.license_scan(table(spark, texts)).orderBy("doc_id").collect()
    assert [(r.licenses, r.n_known) for r in got] == [(name, n) for _, name, n in want for _ in range(6)]


def test_lines(odd, odd_rows, nothing):
    sites = {}
    for _, t, _, s in odd_rows:
        for x in (t or "").split("\n"):
            if s is not None:
                sites.setdefault(x.strip(" "), set()).add(s)
    want = []
    for i, t, *_ in odd_rows:
        own = [] if t is None else t.split("\n")
        gone = [x.strip(" ") != "" and len(sites.get(x.strip(" "), ())) >= 8 for x in own]
        want.append((i, sum(x.strip(" ") != "" for x in own), sum(gone), None if t is None else "\n".join(x for x, g in zip(own, gone) if not g)))
    assert rows_of(lines.without_spread_lines(odd)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert lines.without_spread_lines(nothing).count() == 0


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<i>c</i>d<br>e", "a bcd e"),
    ("<body><nav>x y z</nav><div class='ad'>buy</div><article><h1>T</h1><p>One&nbsp;two</p><div id=comments><p>nice</p></div></article><footer>f</footer>", "T One two"),
    ("<body><header>Site</header><div><p>First words of a text that is long.</p><p>More words of it.</p></div><aside>side</aside><form>f<input></form>"
     "<script>var a='</p>'</script><div class='cookie-notice'>ok</div></body>", "First words of a text that is long. More words of it."),
])
def test_pages(html, text):
    assert htmltext.main_text(html) == text


def test_links_beside_the_article_are_no_text():
    links = "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(8))
    teaser = "<div class=box><h3><a href=/x>Next thing</a></h3><p><a href=/y>read it</a></p></div>"
    first, second, last = "Words of the text here. " * 20, "More words of it here. " * 20, "Short end."
    whole = " ".join(f"Title {first}{second}{last}".split())
    article = f"<article><h1>Title</h1><p>{first}</p><p>{second}</p><p>{last}</p></article>"
    assert htmltext.main_text(f"<body><main><ul>{links}</ul>{article}<ul>{links}</ul>{teaser}</main></body>") == whole
    assert htmltext.main_text(f"<body><main><h1><a href=/>Title</a></h1><section><p>{first}</p><p>{second}</p></section><ul>{links}</ul>"
                              f"<section><p>{last}</p></section></main></body>") == whole


FIRST, SECOND = "Words of the text here. " * 12, "More words of it are here. " * 12


@pytest.mark.parametrize("opening", ['<div id="main" class="content with-sidebar">', '<div class="post hidden-xs">', '<div class="entry topic-social-science">', "<form>", '<div role="form">',
                                     '<div class="widget">', '<div style="display: none" id=app>', "<dialog open>", '<div class="elementor-widget-container">'])
def test_names_never_cut_what_holds_the_text(opening):
    tag = re.match(r"<(\w+)", opening)[1]
    page = f"<body><nav>a b</nav>{opening}<h1>Title</h1><p>{FIRST}</p><p>{SECOND}</p></{tag}><div class=ad>buy</div></body>"
    assert htmltext.main_text(page) == " ".join(f"Title {FIRST}{SECOND}".split())


def test_names_inside_an_article():
    page = f"<article><h1>T</h1><p>{FIRST}</p><div class='notice-of-1848'><p>{SECOND}</p></div><math>x+1</math><div class='related-links'><p>See this other text</p></div></article>"
    assert htmltext.main_text(page) == " ".join(f"T {FIRST}{SECOND} x+1".split())


def test_remarks_go_however_long_they_are():
    remarks = "".join(f"<div class=comment><p>{SECOND}</p></div>" for _ in range(9))
    assert htmltext.main_text(f"<body><div class=post><p>{FIRST}</p></div><div id=comments>{remarks}</div></body>") == FIRST.strip()


def test_headings_and_short_sections_without_article():
    page = f"<body><div id=c><h1>Title</h1><div><p>{FIRST}</p><p>{SECOND}</p><p>{FIRST}</p></div><div><h2>Last</h2><p>Short one.</p><p>And two.</p></div></div></body>"
    assert htmltext.main_text(page) == " ".join(f"Title {FIRST}{SECOND}{FIRST}Last Short one. And two.".split())
    assert htmltext.main_text(f"<body><div><h1>Title</h1><div><div><p>{FIRST}</p><p>{SECOND}</p></div></div></div></body>") == " ".join(f"Title {FIRST}{SECOND}".split())


def test_ties_long_and_deep_pages():
    twice = f"<body><div><p>{FIRST}</p></div><div><p>{FIRST}</p></div></body>"
    assert htmltext.main_text(twice) == htmltext.main_text(twice) and FIRST.strip() in htmltext.main_text(twice)
    long = f"<body><article>{f'<p>{FIRST}</p>' * 5000}</article></body>"
    assert len(htmltext.main_text(long)) == 5000 * len(FIRST) - 1
    deep = "<body>" + "<div>" * 20_000 + f"<p>{FIRST}</p>" + "</div>" * 20_000 + "</span>" * 20_000 + "</body>"
    assert htmltext.main_text(deep) == FIRST.strip()


def test_densities_equal_a_plain_version():
    rng = random.Random(11)

    def tree(depth):
        inner = "".join(rng.choice([f"<p>{prose(rng, rng.randint(1, 30))}</p>", f"<a href=x>{prose(rng, 3)}</a>", "<br>", prose(rng, 4) + " ", "<img>"]) if depth == 0 or rng.random() < 0.5
                        else tree(depth - 1) for _ in range(rng.randint(1, 4)))
        return f"<div>{inner}</div>"

    for _ in range(40):
        page = htmltext.Page()
        page.feed(f"<body>{tree(4)}</body>")
        page.close()
        n = len(page.tags)
        dense, sums = htmltext.densities(page, [False] * n)

        def counts(i, linked=False):
            """Characters, tags, link characters and link tags below an element, by walking it."""
            c = t = lc = lt = 0
            linked = linked or page.tags[i] == "a"
            for part in page.parts[i]:
                if isinstance(part, str):
                    c += len(" ".join(part.split()))
                else:
                    a = counts(part, linked)
                    c, t, lc, lt = c + a[0], t + a[1] + 1, lc + a[2], lt + a[3]
            if page.tags[i] == "a":
                return c, t, c, t + 1
            return c, t, lc, lt

        body = next(i for i, t in enumerate(page.tags) if t == "body")
        bc, _, blc, _ = counts(body)

        def plain(c, t, lc, lt):
            if not c:
                return 0.0
            below = math.log(c / max(1, c - lc) * lc + (blc / bc if bc else 0) * c + math.e)
            return c / max(1, t) * math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / math.log(max(below, math.e))

        for i in range(n):
            assert dense[i] == pytest.approx(plain(*counts(i)))
            own = sum(len(" ".join(p.split())) for p in page.parts[i] if isinstance(p, str))
            assert sums[i] == pytest.approx((plain(own, 1, 0, 0) if own else 0) + sum(plain(*counts(p)) for p in page.parts[i] if not isinstance(p, str)))


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, None, "<p>" * 3000 + "deep"), (1, "u", None)], "page_id long, url string, html string")
    assert rows_of(htmltext.extract(pages)) == [(1, "u", "", 0), (1, None, "deep", 4)]
    assert htmltext.extract(pages.limit(0)).count() == 0


def plain_hit_share(text, windows):
    """Hit words and words, by looking every window up at every place."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit = {q for k, own in windows.items() for p in range(len(found) - k + 1) if tuple(found[p:p + k]) in own for q in range(p, p + k)}
    return len(hit), len(found)


def plain_windows(items):
    windows = {}
    for t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        k = min(13, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(k, set()).add(tuple(w[p:p + k]))
    return windows


def plain_targets(sizes):
    """Shares by weight 1, 2, 3; what a source cannot take (3 times its size) goes to the others, until nothing is left to give."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left, share = total - sum(3 * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * left > 3 * sizes[s] * share}
        if not over:
            return {s: 3 * sizes[s] if s in full else weight[s] * left / share for s in order}
        full |= over


def test_pipeline_stages_against_plain_versions(spark, odd_rows):
    """Every stage on what the stage before kept, row for row where the stage has one right answer, else by its law."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = cut_lineage(given.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
                       .union(table(spark, [(None if r[0] is None else r[0] + 1_000_000, *r[1:]) for r in odd_rows])))
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = cut_lineage(stage(spark, docs, SF))
        steps[name] = before, [tuple(r) for r in docs.collect()]
        if name != "sharding":
            assert docs.columns == given.columns
    assert list(steps) == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]

    before, after = steps["language_id"]
    assert Counter(after) == Counter(r for r in before if any(c.isalpha() for c in r[1] or "")) and len(after) < len(before)

    before, after = steps["near_dedup"]
    groups = plain_groups(before, 5, 80)
    firsts = {r[2] for r in groups if r[2] is not None}
    assert Counter(after) == Counter(set(r for r, g in zip(before, groups) if r[0] in firsts or g[2] is None)) and len(after) < len(before)

    before, after = steps["decontamination"]
    windows = plain_windows(bench)
    clean = [r for r in before for hit, n in [plain_hit_share(r[1], windows)] if not (hit and 20 * hit >= n)]
    assert Counter(after) == Counter(clean) and len(after) < len(before)

    before, after = steps["mixing"]
    words = {r: len((r[1] or "").encode().split()) for r in before}
    copies, sizes, taken, largest = Counter(after), Counter(), Counter(), Counter()
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    for r in before:
        sizes[r[3]] += words[r]
        taken[r[3]] += words[r] * copies[r]
        largest[r[3]] = max(largest[r[3]], words[r])
    for s, goal in plain_targets(sizes).items():
        assert abs(taken[s] - goal) <= largest[s]

    before, after = steps["sharding"]
    assert Counter(r[:-2] for r in after) == Counter(before)
    assert docs.columns == [*given.columns, "shard", "slot"]
    size, slots = Counter(), {}
    for r in after:
        size[r[-2]] += len((r[1] or "").encode()) + 8
        slots.setdefault(r[-2], []).append(r[-1])
    assert set(slots) == set(range(24)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    even, top = sum(size.values()) / 24, max(len((r[1] or "").encode()) + 8 for r in after)
    assert all(abs(x - even) <= 5 * top for x in size.values())  # one cut per level, each off by half a document at most


def test_shards_of_the_pipeline_follow_the_size(spark, monkeypatch):
    docs = table(spark, [(i, "x" * 92, "l", "s") for i in range(400)])
    assert corpus_pipeline.sharding(spark, docs, SF).agg(F.countDistinct("shard")).first()[0] == 24
    monkeypatch.setattr(corpus_pipeline, "TARGET_BYTES", 1_000)
    assert corpus_pipeline.sharding(spark, docs, SF).agg(F.countDistinct("shard")).first()[0] == 40


def test_pipeline_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.where("shard IS NULL").count() == 0
    assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
