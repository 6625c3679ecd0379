"""What the pipeline's stages promise each other: untouched columns, used predictions, mixed and shuffled shards."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almsflow.llm import decontaminate, language, mixing, neardup, shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
HELPERS = ["node", "same", "turn", "row", "_node", "_same", "_turn", "id", "_id", "_crc", "crc", "hash", "_hash", "places", "_places", "size", "_part", "_split", "_order",
           "_u", "_place", "_s", "_n", "_block", "_s2", "_b2", "_draws", "_cut", "_shards", "_source", "_words", "kept", "best", "found", "spans", "lang_pred", "score", "text_crc32"]


def prose(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_columns_of_any_name_stay_as_they_are(spark):
    rng = random.Random(1)
    texts = [prose(rng, 30) for _ in range(12)]
    rows = [(i, texts[i % 12], "en", f"s{i % 3}", 1, *[i * 1000 + k for k in range(len(HELPERS))]) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{h}` long" for h in HELPERS)).repartition(3)
    given = {r.doc_id: tuple(r) for r in docs.collect()}
    bench = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    found = {
        "near": neardup.drop_near_duplicates(docs), "language": language.keep_identified(docs), "benchmark": decontaminate.drop_contaminated(docs, bench),
        "mix": mixing.copies(docs, mixing.plan(docs)).drop("mix_copy", "mix_shard"), "shards": shards.with_shards(docs, 4).drop("shard", "slot"),
        "shuffled": shards.with_shards(docs, 4, shards.mixing_dims(), shuffled=True).drop("shard", "slot")}
    for name, df in found.items():
        assert df.columns == docs.columns, name
        kept = [tuple(r) for r in df.collect()]
        assert kept and all(given[r[0]] == r for r in kept), name
    assert found["near"].count() == 12 and found["benchmark"].count() == 27 and found["shards"].count() == 30


def test_predictions_are_used(spark):
    rng = random.Random(2)
    one, two = "abcdefgh", "stuvwxyz"
    rows = [(i, prose(rng, 60, one if i % 2 else two), "one" if i % 2 else "two", "s", 1) for i in range(80)]
    rows += [(100, prose(rng, 60, one), "two", "s", 1), (102, prose(rng, 60, two), None, "s", 1), (104, prose(rng, 60, one), None, "s", 1), (105, "12 34", "one", "s", 1),
             (106, prose(rng, 60, one), "one", "s", 1), (107, None, None, "s", 1)]
    learned = spark.createDataFrame(rows, SCHEMA)
    held = {r.doc_id for r in learned.where(language.held_out()).collect()}
    texts = language.sample(learned.where("doc_id < 100"), ["one", "two"])
    kept = {r.doc_id: r.lang for r in language.keep_identified(learned, texts).collect()}
    assert kept == {i: "one" if i % 2 else "two" for i in range(80)} | {102: "two", 104: "one", 106: "one"} and held


@pytest.mark.parametrize("group", [1, 2, 128])
def test_labels_in_groups_give_the_same_answers(spark, group):
    rng = random.Random(3)
    alphabets = {f"l{k}": "abcdefghijklmnop"[k * 2:k * 2 + 6] for k in range(5)}
    rows = [(i, prose(rng, 40, alphabets[f"l{i % 5}"]), f"l{i % 5}", "s", 1) for i in range(200)] + [(300, "1 2", "l1", "s", 1), (301, None, "l1", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, group=group).collect()}
    assert found[300] == found[301] == ("und", 0.0)
    whole = language.Model(language.sample(docs, sorted(alphabets)))
    for i, text, lang, *_ in rows[:200]:
        cost, _ = whole.costs([text])
        low = sorted(cost[0])
        assert found[i][0] == whole.langs[int(cost[0].argmin())] == lang
        if group == 128:  # symbols are numbered per group, costs of one group are the plain ones
            assert found[i][1] == pytest.approx(1 - low[0] / low[1])


def test_two_hundred_labels(spark, monkeypatch):
    monkeypatch.setattr(language, "CHARS_PER_LANG", 400)
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
    rows = [(i, prose(rng, 30, letters[(i % 200) * 4:(i % 200) * 4 + 4]), f"l{i % 200:03}", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert len(language.labels(docs)) == 2
    assert all(r.lang_pred == f"l{r.doc_id % 200:03}" for r in language.identify(docs).where("held_out").collect())


def test_shards_carry_the_mix_and_part_the_copies(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(5, 60)), "en", f"s{i % 5 if i % 3 else 0}", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = corpus_pipeline.mixing_stage(spark, docs, "")
    out = corpus_pipeline.sharding(spark, mixed, "")
    found = [(r.shard, r.slot, r.source, r.doc_id, len(r.text)) for r in out.collect()]
    whole = Counter()
    for _, _, s, _, n in found:
        whole[s] += n
    total = sum(whole.values())
    for shard in range(24):
        own = sorted(r for r in found if r[0] == shard)
        size = sum(r[4] for r in own)
        assert abs(size - total / 24) < 0.1 * total / 24
        for s in whole:
            assert abs(sum(r[4] for r in own if r[2] == s) / size - whole[s] / total) < 0.15
        assert [r[1] for r in own] == list(range(len(own)))
    at = {(r[0], r[1]): r[3] for r in found}
    copies = sum(n - 1 for n in Counter(r[3] for r in found).values())
    assert copies > 300 and sum(at.get((a, b - 1)) == d for (a, b), d in at.items()) < 0.05 * copies
    home = {}
    for r in found:
        assert home.setdefault(r[3], r[0]) == r[0]  # equal texts share a shard


def test_equal_texts_share_a_shard_unless_they_are_most_of_it(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 40), f"l{i % 3}", "s", 1) for i in range(400)]
    rows += [(1000 + i, rows[i % 40][1], f"l{i % 4}", "t", 1) for i in range(120)]
    rows += [(2000 + i, "one text in very many rows " * 8, "l0", "u", 1) for i in range(500)] + [(3000, "twice", "l0", "u", 1)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    text = {i: t for i, t, *_ in rows}
    placed = shards.assign(docs, shards.default_dims(), 12).collect()
    sizes, homes = Counter(), {}
    for r in placed:
        sizes[r.shard] += r.size
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(h) == 1 for t, h in homes.items() if not t.startswith("one text"))
    even = sum(sizes.values()) / 12
    assert len(homes["one text in very many rows " * 8]) > 2 and all(abs(s - even) < 0.15 * even for s in sizes.values())
