import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almsflow.functions import similarity as S
from almsflow.operators import match as M, nearest as N


def lcs_plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            row[j], prev = (prev + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if not a and not b else 200 * lcs_plain(a, b) / (len(a) + len(b))


def test_lcs_matches_plain_definition():
    rnd = random.Random(1)
    left = ["".join(rnd.choices("ABCÉ ", k=rnd.randint(0, 200))) for _ in range(300)]
    right = ["".join(rnd.choices("ABCÉ ", k=rnd.randint(0, 200))) for _ in range(300)]
    got = S.lcs_lengths(left, right)
    assert got.tolist() == [lcs_plain(a, b) for a, b in zip(left, right)]
    assert S.lcs_lengths(["KITTEN", ""], ["SITTING", ""]).tolist() == [4, 0]
    edge = "".join(rnd.choices("AB", k=64))
    assert S.lcs_lengths([edge, edge * 2], [edge, edge]).tolist() == [64, 64]


def test_token_sort_score(spark):
    df = spark.createDataFrame([("B A", "A B"), ("KITTEN", "SITTING"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(S.token_sort_score(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 100 and got[1] == pytest.approx(200 * 4 / 13) and got[2] == 100


WORDS = ["RED", "CROSS", "AAAA", "HOSPITAL", "OF", "SAINT", "MARY", "CHURCH", "A", "YMCA", "77", "LAKE", "É", "FDN"]


def noisy(rnd, words):
    text = " ".join(words)
    for _ in range(rnd.randint(0, 5)):
        i = rnd.randint(0, max(0, len(text) - 1))
        text = text[:i] + rnd.choice(["", "X", "E", "EE", " "]) + text[i + rnd.randint(0, 1):]
    return text


def fixture(seed, n_grants, n_orgs):
    rnd = random.Random(seed)
    base = [[rnd.choice(WORDS) for _ in range(rnd.randint(1, 5))] for _ in range(40)]
    grants = [(noisy(rnd, rnd.choice(base)), rnd.choice(["Saint Paul", "Ely", None]), rnd.choice(["MN", "wi ", "ZZ"]),
               rnd.choice(["55101", "55102-1", "6", None])) for _ in range(n_grants)]
    orgs = [(i + 1, noisy(rnd, rnd.choice(base)), rnd.choice(["ST PAUL", "ELY", ""]), rnd.choice(["MN", "WI"]),
             rnd.choice(["55101", "55102"]), i) for i in range(n_orgs)]
    return grants, orgs


def brute(cleaned, registry, threshold):
    """The matching rule written directly: best of the ZIP, else best of the state."""
    out = {}
    for name, city, state, zip_ in cleaned:
        rows = [r for r in registry if r[0] == state]
        if not rows:
            out[name, city, state, zip_] = (None, None, None)
            continue
        last = {key: ein for _, _, key, ein, _ in rows}
        query, found = f"{name}|{city}", None
        pools = [("zip+fuzzy", [r[2] for r in rows if r[1] == zip_] if zip_ else []), ("state_fuzzy", list(last))]
        for label, keys in pools:
            best = max(keys, key=lambda k: ratio(query, k), default=None)
            if best is not None and ratio(query, best) >= threshold:
                found = (last[best], ratio(query, best), label)
                break
        out[name, city, state, zip_] = found or (None, 0.0, "no_match")
    return out


@pytest.mark.parametrize("seed,threshold", [(3, 85), (4, 85), (5, 92), (6, 76), (7, 60)])
def test_pruned_match_equals_brute_force(spark, seed, threshold):
    grants, orgs = fixture(seed, 150, 150)
    g = spark.createDataFrame(grants, "recipient_name string, recipient_city string, recipient_state string, recipient_zip string")
    r = spark.createDataFrame(orgs, "EIN long, NAME string, CITY string, STATE string, ZIP string, ord long")
    who = M.with_clean_recipients(g).select(*M.CLEAN_KEY).distinct()
    registry = [tuple(x) for x in M.clean_registry(r).orderBy("ord").collect()]
    expected = brute([tuple(x) for x in who.collect()], registry, threshold)
    got = {tuple(x)[:4]: tuple(x)[4:] for x in M.match_recipients(who, r, threshold).collect()}
    assert got.keys() == expected.keys()
    for key, want in expected.items():
        assert got[key][0] == want[0] and got[key][2] == want[2], (key, got[key], want)
        assert got[key][1] == pytest.approx(want[1]) if want[1] is not None else got[key][1] is None
    kinds = {v[2] for v in expected.values()}
    assert {"zip+fuzzy", "state_fuzzy", None} <= kinds


def test_infer_keeps_every_usable_grant(spark):
    g = spark.createDataFrame([("Red Cross", "Ely", "MN", "55101"), ("Red Cross", "Ely", "MN", "55101"),
                               ("Other", "X", "TX", None), (None, "X", "TX", None), ("Inc.", "X", "TX", None)],
                              "recipient_name string, recipient_city string, recipient_state string, recipient_zip string")
    r = spark.createDataFrame([(5, "RED CROSS INC", "ELY", "MN", "55101", 0), (9, "Red Cross", "Ely", "MN", "99999", 1)],
                              "EIN long, NAME string, CITY string, STATE string, ZIP string, ord long")
    rows = M.infer_recipients(g, r).collect()
    assert len(rows) == 3
    assert sorted((x.recipient_name, x.inferred_ein, x.match_type) for x in rows if x.inferred_ein) == [
        ("Red Cross", 9, "zip+fuzzy")] * 2
    assert [(x.match_score, x.match_type) for x in rows if x.recipient_state == "TX"] == [(None, None)]
    none = M.infer_recipients(g, r.withColumn("STATE", F.lit("CA"))).collect()
    assert {(x.match_score, x.match_type) for x in none} == {(0.0, "no_match")}


def test_pluggable_scorer(spark):
    g = spark.createDataFrame([("Red Cros", "Ely", "MN", None)], M.with_clean_recipients.__doc__ and
                              "recipient_name string, recipient_city string, recipient_state string, recipient_zip string")
    r = spark.createDataFrame([(5, "RED CROSS", "ELY", "MN", "55101", 0)],
                              "EIN long, NAME string, CITY string, STATE string, ZIP string, ord long")
    row = M.infer_recipients(g, r, 50, S.levenshtein_score).first()
    assert row.inferred_ein == 5 and row.match_type == "state_fuzzy"


def all_best(left, right, threshold):
    """Every left row's best partners by scoring all pairs."""
    out = set()
    for i, x in enumerate(left):
        scores = [100.0 if not x and not y else 200.0 * lcs_plain(x, y) / (len(x) + len(y)) for y in right]
        top = max(scores, default=-1)
        out |= {(i, j, s) for j, s in enumerate(scores) if s == top and s >= threshold}
    return out


def searched(left, right, threshold):
    found = [np.concatenate(x) for x in zip(*N.candidates(left, right, threshold))]
    assert len(set(zip(found[0].tolist(), found[1].tolist()))) == len(found[0])
    l, r, score, tried = N.best_of(left, right, *found, threshold)
    return set(zip(l.tolist(), r.tolist(), score.tolist())), tried


@pytest.mark.parametrize("threshold", [-5, 0, 0.4, 20, 50, 60, 75, 76, 79.5, 80, 81, 85, 92, 100, 101])
def test_search_of_short_strings_equals_all_pairs(threshold):
    texts = ["".join(t) for n in range(0, 5) for t in itertools.product("AB|", repeat=n)] + ["A|ELYX", "ALPHA|ELY", "A" * 9, "ALPHAB|ELY"]
    assert searched(texts, texts, threshold)[0] == all_best(texts, texts, threshold)


@pytest.mark.parametrize("threshold", [0, 30, 60, 75, 85, 93, 100])
@pytest.mark.parametrize("seed,expanded", [(1, 2_000_000), (2, 50), (3, 1)])
def test_search_equals_all_pairs(seed, expanded, threshold, monkeypatch):
    monkeypatch.setattr(N, "EXPANDED", expanded)
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(30)]
    texts = [" ".join(rnd.sample(words, rnd.randint(1, 5))) for _ in range(60)]
    left = texts[:40] + [t[:-1] for t in texts[:20]] + [noisy(rnd, t.split()) for t in texts[:20]]
    right = list(dict.fromkeys(texts + [t + "x" for t in texts[:10]] + ["a" * 70, "ab" * 90, ""]))
    assert searched(left, right, threshold)[0] == all_best(left, right, threshold)
    assert searched([], right, threshold) == (set(), 0) and searched(left, [], threshold) == (set(), 0)


@pytest.mark.parametrize("chunk", [3, 50])
def test_chunks_of_a_block_meet(spark, monkeypatch, chunk):
    monkeypatch.setattr(N, "LEFT_CHUNK", chunk)
    monkeypatch.setattr(N, "RIGHT_CHUNK", 2 * chunk)
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 6))) for _ in range(12)]
    texts = list(dict.fromkeys(" ".join(rnd.sample(words, rnd.randint(1, 4))) for _ in range(120)))
    left = spark.createDataFrame([("S" if i % 4 else f"T{i % 16}", t) for i, t in enumerate(texts)], "state string, text string")
    right = spark.createDataFrame([("S" if i % 3 else f"T{i % 16}", t[:-1], [i], i) for i, t in enumerate(texts)], "state string, text string, ids array<int>, ord long")
    right = right.dropDuplicates(["state", "text"])
    found = {(r.state, r.text, r.r_text, r.score) for r in N.search(left, right, ["state"], 70).collect()}
    want, sides = set(), [{}, {}]
    for held, side in zip(sides, (left, right)):
        for r in side.collect():
            held.setdefault(r.state, []).append(r.text)
    for state in sides[0]:
        own, other = sides[0][state], sides[1].get(state, [])
        want |= {(state, own[i], other[j], s) for i, j, s in all_best(own, other, 70)}
    best = {}
    for state, text, _, s in found:
        best[state, text] = max(best.get((state, text), 0), s)
    # Every meeting of chunks gives its own best; the best of these are those of the block.
    assert {f for f in found if f[3] == best[f[0], f[1]]} == want


def test_a_foreign_scorer_is_tried_on_all_pairs(spark):
    left = spark.createDataFrame([("S", "ALPHA|ELY")], "state string, text string")
    right = spark.createDataFrame([("S", "ALPHA BETA GAMMA DELTA OMEGA|ELY", "k", 7, 0)], "state string, text string, key string, ein long, ord long")
    for threshold in (50, 85):
        assert M.best_matches(left, right, ["state"], threshold, lambda a, b: F.lit(100.0)).first().ein == 7


def test_few_page_titles_are_scored(spark):
    """Less than a hundredth of the pairs inside a state are scored, of titles made of few syllables."""
    from almsflow.functions import text as X
    from almsflow.plans import catalog

    grants, registry = catalog._sites(spark, "/root/testdata/sf0.1")
    sides = [M.with_clean_recipients(grants).select(F.col(M.CLEAN_KEY[2]).alias("state"), X.sorted_tokens(
        X.lookup_key(F.col(M.CLEAN_KEY[0]), F.col(M.CLEAN_KEY[1]))).alias("text")), M.clean_registry(registry).select("state", X.sorted_tokens(F.col("key")).alias("text"))]
    held = []
    for side in sides:
        held.append({})
        for r in side.distinct().collect():
            held[-1].setdefault(r.state, []).append(r.text)
    tried = pairs = 0
    for state, own in held[0].items():
        other = held[1].get(state, [])
        pairs += len(own) * len(other)
        tried += searched(own, other, 85)[1] if other else 0
    assert 0 < tried < pairs / 100


def test_the_longest_task_of_a_block_is_bounded():
    """A group of two chunks is never divided, so chunks must stay about as small as the work meant for a task."""
    from almsflow.operators import nearest
    assert nearest.LEFT_CHUNK * nearest.RIGHT_CHUNK <= 1.1 * nearest.PAIRS_PER_TASK <= 5_000_000


def test_characters_bound_the_pairs_of_few_syllables():
    """Titles of the same few syllables share most grams; the characters they share rule out half of what is left, or more."""
    rnd = random.Random(5)
    syllables = "th on er ha st re nd ou ea en wh ti or at es".split()
    titles = [" ".join(sorted("".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(11)))[:60] for _ in range(700)]
    left, right = titles[:300], titles[300:]
    for threshold, most in ((85, 0.1), (75, 0.8)):
        l, r, top = (np.concatenate(x) for x in zip(*N.candidates(left, right, threshold)))
        assert 0 < len(l) < most * len(left) * len(right)
        for i in range(0, len(l), 997):
            assert lcs_plain(left[l[i]], right[r[i]]) <= top[i]


@pytest.mark.parametrize("columns,dense", [(1_024, 1 / 200), (7, 0.0), (1_024, 2.0), (3, 0.05)])
def test_shared_items_are_counted_like_multisets(monkeypatch, columns, dense):
    """By products of matrices, in slices of columns, pair by pair, and by both."""
    from collections import Counter
    monkeypatch.setattr(N, "COLUMNS", columns)
    monkeypatch.setattr(N, "DENSE", dense)
    rnd = random.Random(2)
    left, right = (["", *("".join(rnd.choices("AABCÉ😀|", k=rnd.randint(0, 12))) for _ in range(n))] for n in (30, 50))
    sides, size = N._characters(left, right)
    kinds = [(sides, lambda t: Counter(t)), ([N._grams(*s, size) for s in sides], lambda t: Counter(zip(t, t[1:])))]
    for (own, other), counter in kinds:
        got = N._Shared(own, other, len(left), len(right)).of(3, 20)
        assert got.tolist() == [[(counter(x) & counter(y)).total() for y in right] for x in left[3:20]]


def test_pairs_of_rows_are_scored_like_single_pairs(monkeypatch):
    monkeypatch.setattr(S, "_CELLS", 300)
    monkeypatch.setattr(S, "_TOGETHER", 7)
    rnd = random.Random(3)
    left, right = (["", *("".join(rnd.choices("ABCÉ ", k=rnd.choice([1, 20, 63, 64, 65, 128, 150]))) for _ in range(20))] for _ in range(2))
    l, r = (x.ravel() for x in np.indices((len(left), len(right))))
    assert S.Lcs(left, right).lengths(l, r).tolist() == [lcs_plain(left[i], right[j]) for i, j in zip(l, r)]
    assert S.Lcs([], []).lengths(l[:0], r[:0]).tolist() == []
