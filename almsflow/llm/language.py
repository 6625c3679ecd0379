"""Language identification by cross-parsing entropy.

Labelled text of every language becomes a suffix automaton. A text is cut greedily into the
longest phrases that occur in a language's labelled text, by walking its automaton; the
number of phrases times the bits needed to point at one (log2 of the labelled length) is the
cost under that language, and the cheapest language wins.

Learning uses a bounded sample: per language ``rows_per_lang`` labelled rows drawn by a hash of
their id, ``chars_per_lang`` symbols of them. Every text is predicted over its whole length; a
text is walked in pieces of ``PIECE`` symbols so that many pieces advance together as numpy
vectors, and the phrase counts of its pieces are added.

The driver learns the automata, of one group of ``GROUP_LANGS`` labels at a time, and sends their edges; tasks lay these
out as tables while they run. More labels make more groups, through which a text passes one after the other with its
two lowest costs so far, so any number of labels is compared.

Defined cases: null text or text without a letter is ``und`` with score 0; rows without label,
text or id teach nothing; equal costs go to the label that sorts first; with one known language the score is 1;
repeated rows get equal answers; without any labelled text every answer is ``und``; other columns may have any name.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from almsflow.llm.tables import kept, row_struct, steps, uniform
from almsflow.runtime import cut_lineage

ROWS_PER_LANG = 160
CHARS_PER_LANG = 40_000
#: Labels learned and sent together: about 1 MB of edges each.
GROUP_LANGS = 128
PIECE = 512
#: Symbols: 0 all that is not a letter, then the letters of the labelled sample, the commonest first, and last
#: one for letters no label has. Symbols below ``DENSE`` have table columns, the others sorted keys.
DENSE = 63
UNKNOWN = "und"
#: Tables of so many languages stay laid out while a task runs, about 15 MB each; of more, one after the other.
KEPT_TABLES = 8
#: Characters parsed together.
STEP_CHARS = 1_000_000
#: A prediction with this score or more overrules a label.
MARGIN = 0.4


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are kept out of learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _usable(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))


def labels(docs: DataFrame, size: int = 0) -> list[list[str]]:
    """The labels that have text to learn from, sorted, in groups."""
    found = sorted(r["lang"] for r in _usable(docs).select("lang").distinct().collect())
    size = size or GROUP_LANGS
    return [found[i:i + size] for i in range(0, len(found), size)]


def sample(docs: DataFrame, langs: list[str], rows_per_lang: int = ROWS_PER_LANG, chars_per_lang: int = CHARS_PER_LANG) -> dict[str, str]:
    """Labelled text of each of ``langs``, at most ``chars_per_lang`` characters."""
    usable = _usable(docs).where(F.col("lang").isin(langs))
    first = Window.partitionBy("lang").orderBy("_draw", "doc_id")
    chosen = (usable.select("lang", "doc_id", uniform(F.col("doc_id"), 10).alias("_draw"))
              .withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= rows_per_lang)
              .select("lang", "doc_id", "_rank").collect())
    if not chosen:
        return {}
    picked = docs.sparkSession.createDataFrame(chosen, "lang string, doc_id long, _rank int").dropDuplicates(["lang", "doc_id"])
    each = -(-4 * chars_per_lang // rows_per_lang)
    # Repeated rows of one id would all match: as many distinct texts as rows are asked for come back.
    texts = (usable.select("lang", F.col("doc_id").cast("long").alias("doc_id"), F.left("text", F.lit(each)).alias("text"))
             .join(F.broadcast(picked), ["lang", "doc_id"]).groupBy("lang", "_rank").agg(F.min("text").alias("text")).collect())
    out: dict[str, str] = {}
    for r in sorted(texts, key=lambda r: (r["lang"], r["_rank"])):
        out[r["lang"]] = (out.get(r["lang"], "") + "\n" + r["text"].lower())[:chars_per_lang]
    return out


def automaton_edges(symbols: list[int]) -> tuple[int, np.ndarray]:
    """The suffix automaton of one symbol sequence: how many states, and its edges as rows (state, symbol, next state)."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return len(following), np.array([(s, c, to) for s, edges in enumerate(following) for c, to in edges.items()], np.int32).reshape(-1, 3)


class SuffixAutomaton:
    """Edges laid out for walking; ``table[state, symbol]`` is the next state or -1.

    Edges of symbols from ``DENSE`` on are ``targets`` of the ascending ``keys`` state * width + symbol;
    the last table column is -1 and stands for all of these.
    """

    def __init__(self, states: int, edges: np.ndarray, width: int):
        state, symbol, to = edges.T
        self.table = np.full((states, DENSE + 1), -1, np.int32)
        common = symbol < DENSE
        self.table[state[common], symbol[common]] = to[common]
        self.root = np.zeros(width, np.int32)
        self.root[symbol[state == 0]] = to[state == 0]
        keys = state[~common].astype(np.int64) * width + symbol[~common]
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], to[~common][order]


def _collapse(symbols: np.ndarray) -> np.ndarray:
    """Which symbols stay when a run of non-letters counts once."""
    return (symbols > 0) | np.concatenate([[True], symbols[:-1] > 0])


class Model:
    """The automata of some languages over one table of symbols. Pickled, it is their edges only."""

    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(texts)
        letters = Counter(c for t in texts.values() for c in t if c.isalpha())
        self.other = max(DENSE, len(letters) + 1)
        self.symbol_of = np.zeros(0x110000, np.min_scalar_type(self.other))
        for cp in range(0x110000):
            if chr(cp).isalpha():
                self.symbol_of[cp] = self.other
        for number, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))):
            for form in {c, c.upper()}:
                if len(form) == 1:
                    self.symbol_of[ord(form)] = number + 1
        self.edges, self.bits = [], []
        for lang in self.langs:
            symbols = self.symbols(texts[lang])
            symbols = symbols[_collapse(symbols)]
            self.edges.append(automaton_edges(symbols.tolist()))
            self.bits.append(float(np.log2(max(2, len(symbols)))))

    def automata(self) -> Iterator[SuffixAutomaton]:
        """One language's table at a time where they are many, else all of them kept."""
        if len(self.langs) > KEPT_TABLES:
            yield from (SuffixAutomaton(*e, self.other + 1) for e in self.edges)
            return
        if not hasattr(self, "_tables"):
            self._tables = [SuffixAutomaton(*e, self.other + 1) for e in self.edges]
        yield from self._tables

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def phrases(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language, and whether the text has a letter (last column).

        ``flat`` holds the symbols of all texts one after the other.
        """
        out = np.zeros((len(lengths), len(self.langs) + 1), np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        stays = _collapse(flat)
        starts = np.cumsum(lengths) - lengths
        stays[starts[lengths > 0]] = True
        flat, owner = flat[stays], owner[stays]
        out[:, -1] = np.bincount(owner[flat > 0], minlength=len(lengths))
        sizes = np.bincount(owner, minlength=len(lengths))
        pieces = -(-sizes // PIECE)
        piece_owner = np.repeat(np.arange(len(lengths)), pieces)
        inner = np.arange(len(piece_owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + inner * PIECE
        size = np.minimum(PIECE, np.repeat(sizes, pieces) - inner * PIECE)
        order = np.argsort(-size, kind="stable")
        begin, size, piece_owner = begin[order], size[order], piece_owner[order]
        if not len(size):
            return out
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
        sparse = self.other > DENSE and bool((flat >= DENSE).any())
        for k, automaton in enumerate(self.automata()):
            table, root = automaton.table.ravel(), automaton.root
            keys = automaton.keys if sparse else ()
            state = np.zeros(len(size), np.int32)
            count = np.ones(len(size), np.int32)
            for j, n in enumerate(alive.tolist()):
                c = flat[begin[:n] + j]
                to = table[state[:n] * (DENSE + 1) + (np.minimum(c, DENSE) if sparse else c)]
                if len(keys):
                    rare = np.flatnonzero(c >= DENSE)
                    wanted = state[rare].astype(np.int64) * len(root) + c[rare]
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    to[rare] = np.where(keys[place] == wanted, automaton.targets[place], -1)
                ended = to < 0
                count[:n] += ended
                state[:n] = np.where(ended, root[c], to)
            out[:, k] = np.bincount(piece_owner, count, len(lengths)).astype(np.int64)
        return out

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost of every text in every language, and whether it has a letter."""
        found = self.phrases(self.symbols("".join(texts)), np.array([len(t) for t in texts], np.int64))
        return found[:, :-1] * np.array(self.bits), found[:, -1] > 0


_SO_FAR = T.StructType([T.StructField("lang", T.StringType()), T.StructField("low", T.DoubleType()), T.StructField("next", T.DoubleType())])
_SO_FAR_ARROW = pa.struct([("lang", pa.string()), ("low", pa.float64()), ("next", pa.float64())])


def merged(langs: list[str], cost: np.ndarray, known: np.ndarray, before: list[dict | None]) -> list[dict | None]:
    """The cheapest label with its cost and the cost of the next one, over these languages and those before."""
    out: list[dict | None] = []
    first = cost.argmin(axis=1)
    two = np.partition(cost, 1, axis=1)[:, 1] if len(langs) > 1 else np.full(len(cost), np.inf)
    for row, (k, second, b) in enumerate(zip(first.tolist(), two.tolist(), before)):
        if not known[row]:
            out.append(None)
            continue
        now = {"lang": langs[k], "low": float(cost[row, k]), "next": second}
        if b:
            best, other = (b, now) if b["low"] <= now["low"] else (now, b)
            now = {"lang": best["lang"], "low": best["low"], "next": min(best["next"], other["low"])}
        out.append(now)
    return out


def _judged(shared: Broadcast, key: str, text: Column, before: Column) -> Column:
    def judge(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        model = kept(key, lambda: shared.value)
        for texts, earlier in batches:
            texts, earlier = [t or "" for t in texts.to_pylist()], earlier.to_pylist()
            out: list[dict | None] = []
            for a, b in steps(texts, STEP_CHARS):
                out += merged(model.langs, *model.costs(texts[a:b]), earlier[a:b])
            yield pa.array(out, _SO_FAR_ARROW)
        pa.default_memory_pool().release_unused()

    # Else the optimizer runs it again in filters on its result.
    return F.arrow_udf(judge, _SO_FAR).asNondeterministic()(text, before)


def with_prediction(docs: DataFrame, *columns: Column, texts: dict[str, str] | None = None, group: int = 0) -> DataFrame:
    """``columns`` of every document plus struct ``found``: lang_pred and score.

    Only texts go to Python and only answers come back.
    """
    groups = [texts] if texts is not None else None
    if groups is None:
        groups = (sample(docs, langs) for langs in labels(docs, group))
    rows = docs.select(F.struct(*columns).alias("kept"), "text", F.lit(None).cast(_SO_FAR).alias("best"))
    seen = 0
    for number, texts in enumerate(groups):
        if not texts:
            continue
        if number:
            rows = cut_lineage(rows)  # a group of labels is alive at a time
        shared = docs.sparkSession.sparkContext.broadcast(Model(texts))
        rows = rows.select("kept", "text", _judged(shared, uuid.uuid4().hex, F.col("text"), F.col("best")).alias("best"))
        seen += len(texts)
    score = F.lit(1.0) if seen == 1 else F.when(F.col("best.next") > 0, 1 - F.col("best.low") / F.col("best.next")).otherwise(0.0)
    found = F.struct(F.coalesce("best.lang", F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("best.lang").isNull(), 0.0).otherwise(score).alias("score"))
    return rows.select("kept", found.alias("found"))


def identify(docs: DataFrame, texts: dict[str, str] | None = None, group: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (margin of the winner over the runner-up)."""
    out = with_prediction(docs, F.col("doc_id").alias("doc_id"), held_out().alias("held_out"), texts=texts, group=group)
    return out.select("kept.*", "found.*")


def keep_identified(docs: DataFrame, texts: dict[str, str] | None = None, margin: float = MARGIN) -> DataFrame:
    """The documents whose language is told and does not speak against their label, with all their columns.

    A document goes if it is ``und``, or if its label differs from a prediction whose score is ``margin`` or more; a null
    label becomes the prediction. Documents without a learned label, or with a label that nothing was learned of, keep it unless ``und``.
    """
    found = with_prediction(docs, row_struct(docs).alias("row"), texts=texts).select("kept.row", "found.*")
    known = [lang for own in labels(docs) for lang in own] if texts is None else sorted(texts)
    against = F.col("row.lang").isin(known) & (F.col("row.lang") != F.col("lang_pred")) & (F.col("score") >= margin)
    stay = (F.col("lang_pred") != UNKNOWN) & ~F.coalesce(against, F.lit(False))
    names = [F.coalesce("row.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns]
    return found.where(stay).select(*names)
