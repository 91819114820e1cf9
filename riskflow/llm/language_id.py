"""Language identification by cross-parsing entropy.

Some labelled text of each language becomes a suffix automaton, which accepts exactly the
substrings of that text. A document is parsed from left to right into the longest phrases
that the automaton accepts. The fewer phrases it needs per letter, normalised by the size
of the automaton's text, the closer the language; the one that needs the fewest wins.

The labelled text is a bounded sample: the documents of each language with the smallest
hashes of their ids, up to `sample_documents` documents and `sample_letters` letters a
language. Automata are rows of moves, sent to every task once; `table_letters` bounds what
all languages have together, so the size sent doesn't grow with the data. Documents are
parsed whole, cut into stretches that many at a time step through the tables together; a
cut costs at most one phrase.

The winner need not fit. A text is `known` if the winner's phrases take few enough bits
against spelling it letter by letter (see SPELLING_RATIO); strings of random letters and
scripts that no labelled text has are not. Short texts are: two phrases are always spared.

Defined results: NULL texts and texts without a letter are `und` with score 0; NULL
labels are not learned; without a labelled document every text with a letter is known; equal scores go to the first language by code point; repeated rows
are judged each; without a labelled document all others are `und`; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Letters of text in one stretch, and stretches parsed together.
STRETCH = 512
TOGETHER = 2048
#: Letters of text in memory at a time (one document at least).
LETTERS_AT_A_TIME = 1 << 20
#: Bases tried for a state of several moves, side by side and then anywhere, before the row
#: of moves is extended.
TRIES = 64
#: A language explains a text whose phrases take at most this many times the bits of
#: spelling it in the language's letters, all equally likely, and some phrases beyond that.
SPELLING_RATIO = 2.0
SPARE_PHRASES = 2


@dataclass(frozen=True)
class Automaton:
    """Moves of every state by symbol; `automaton[state, symbol]` is -1 where there is none."""

    moves: list[dict[int, int]]
    n_symbols: int

    def __getitem__(self, place: tuple[int, int]) -> int:
        return self.moves[place[0]].get(int(place[1]), -1)


@dataclass(frozen=True)
class Steps:
    """The moves of an automaton in one row: that of a state by a symbol stands at
    `base[state] + symbol`, if `owner` there is the state. `first` has the moves of the
    beginning, 0 where there is none, and `unknown` whether there is none."""

    base: np.ndarray
    owner: np.ndarray
    to: np.ndarray
    first: np.ndarray
    unknown: np.ndarray


@dataclass(frozen=True)
class Model:
    """Per language the moves of its automaton, and the symbol of every code point.

    Symbol 0 is whatever isn't a letter; every letter of the learned texts has its own,
    and the last symbol stands for letters that none of them has.
    """

    languages: list[str]
    tables: list[Steps]
    lengths: list[int]
    symbols: np.ndarray
    n_symbols: int


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of every code point that is a letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def folded(points: np.ndarray) -> np.ndarray:
    """Lower-case letters; every run of other characters becomes one 0."""
    low = _letters()[points]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0)
    return low[keep]


def suffix_automaton(symbols: np.ndarray, n_symbols: int) -> Automaton:
    """The suffix automaton of a text, which accepts just its substrings.

    Built letter by letter in time linear in the text.
    """
    size = 2 * len(symbols) + 2
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols.tolist():
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    assert len(moves) <= size
    return Automaton(moves, n_symbols)


def stepping(automaton: Automaton) -> Steps:
    """The moves in one row, so that its size goes with the moves, not states x symbols.

    States of several moves are fitted in between each other, those of many first; states
    of one move take the places left.
    """
    moves, n = automaton.moves, automaton.n_symbols
    base = np.zeros(len(moves), np.int64)
    several = sorted((s for s, m in enumerate(moves) if len(m) > 1), key=lambda s: -len(moves[s]))
    single = [s for s, m in enumerate(moves) if len(m) == 1]
    used = bytearray(n)  # bases are counted from n, lest those of single moves be negative
    low, end = n, n
    spread = np.random.default_rng(0).random(TRIES).tolist()
    for s in several:
        keys = sorted(moves[s])
        while low < len(used) and used[low]:
            low += 1
        near = max(n, low - keys[0])
        anywhere = [n + int(x * (end - n)) for x in spread]
        for at in (*range(near, near + TRIES), *anywhere):
            if at + n > len(used):
                used.extend(bytes(len(used) + n))
            if not any(used[at + c] for c in keys):
                break
        else:
            low += 1  # crowded: leave this place to single moves
            at = max(n, end - keys[0])
            if at + n > len(used):
                used.extend(bytes(len(used) + n))
        for c in keys:
            used[at + c] = 1
        end = max(end, at + keys[-1] + 1)
        base[s] = at
    free = np.flatnonzero(np.frombuffer(bytes(used), np.uint8)[n:] == 0) + n
    free = np.concatenate([free, np.arange(len(single)) + len(used)])[: len(single)]
    base[single] = free - np.array([next(iter(moves[s])) for s in single], np.int64)
    counts = np.array([len(m) for m in moves])
    states = np.repeat(np.arange(len(moves)), counts)
    keys = np.fromiter((c for m in moves for c in m), np.int64, len(states))
    places = base[states] + keys
    size = int(max(base.max(), places.max(initial=0))) + n + 1
    owner, to = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    owner[places] = states
    to[places] = np.fromiter((x for m in moves for x in m.values()), np.int64, len(states))
    first, unknown = np.zeros(n, np.int32), np.ones(n, bool)
    first[list(moves[0])], unknown[list(moves[0])] = list(moves[0].values()), False
    return Steps(base.astype(np.int32), owner, to, first, unknown)


def fit(
    labelled: DataFrame,
    text: str,
    label: str,
    order: Column,
    sample_documents: int = 200,
    sample_letters: int = 60_000,
    table_letters: int = 400_000,
) -> Model:
    """Automata from a bounded sample of `labelled` rows; `order` decides which are taken.

    At most `sample_documents` rows of a language come to the driver, cut to the bytes
    that its share of letters can need.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    known = known.select(
        F.col(label).alias("lang"), F.col(text).alias("text"), order.alias("place")
    )
    # First, on labels and hashes alone, the last place of each language's sample.
    nth = F.row_number().over(W.partitionBy("lang").orderBy("place"))
    ranked = known.select("lang", "place").withColumn("n", nth).filter(f"n <= {sample_documents}")
    last = ranked.groupBy("lang").agg(F.max("place").alias("last")).collect()
    within = F.lit(False)
    for row in last:  # one per language, as there will be tables
        within = within | ((F.col("lang") == row["lang"]) & (F.col("place") <= row["last"]))
    places = W.partitionBy("lang").orderBy("place", "text")
    letters = F.sum(F.length("text")).over(places.rowsBetween(W.unboundedPreceding, -1))
    taken = known.filter(within).withColumns(
        {"text": F.substring("text", 1, sample_letters), "n": F.row_number().over(places)}
    )
    taken = taken.filter(F.col("n") <= sample_documents)
    taken = taken.withColumn("before", F.coalesce(letters, F.lit(0)))
    rows = taken.filter(F.col("before") < 2 * sample_letters).orderBy("lang", "n").collect()
    texts: dict[str, list[np.ndarray]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append(folded(code_points(row["text"])))
    languages = sorted(texts, key=lambda x: x.encode())
    each = min(sample_letters, table_letters // max(1, len(languages)))
    samples = [np.concatenate(texts[x])[:each] for x in languages]
    known_letters = np.unique(np.concatenate([*samples, np.zeros(1, np.uint32)]))
    known_letters = known_letters[known_letters > 0]
    n = len(known_letters) + 2
    symbols = np.full(0x110000, n - 1, np.min_scalar_type(n - 1))
    symbols[0] = 0
    symbols[known_letters] = np.arange(1, n - 1)
    tables = [stepping(suffix_automaton(symbols[s], n)) for s in samples]
    return Model(languages, tables, [max(2, len(s)) for s in samples], symbols, n)


def phrases(model: Model, symbols: list[np.ndarray]) -> np.ndarray:
    """Number of phrases per document and language."""
    lengths = np.fromiter(map(len, symbols), np.int64, len(symbols))
    cuts = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(symbols)), cuts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    flat = np.concatenate([*symbols, np.zeros(1, np.uint8)])
    begin = np.repeat(np.cumsum(lengths) - lengths, cuts) + part * STRETCH
    size = np.minimum(STRETCH, lengths[owner] - part * STRETCH)
    order = np.argsort(-size, kind="stable")  # those that end early leave from the back
    out = np.zeros((len(symbols), len(model.languages)), np.int64)
    for low in range(0, len(order), TOGETHER):
        group = order[low : low + TOGETHER]
        longest = int(size[group[0]])
        # One row per step, so that a step reads its letters side by side.
        steps = begin[group][None, :] + np.arange(longest)[:, None]
        letters = flat[np.minimum(steps, len(flat) - 1)].astype(np.int32)
        active = np.searchsorted(-size[group], -np.arange(longest), side="left")
        for k, table in enumerate(model.tables):
            state = np.zeros(len(group), np.int32)
            count = np.zeros(len(group), np.int32)
            for step, n in enumerate(active.tolist()):
                # Where the text can't go on, the phrase ends before the letter, which begins
                # the next one. A letter that the text doesn't have is a phrase by itself.
                now, letter = state[:n], letters[step, :n]
                place = table.base.take(now) + letter
                goes_on = table.owner.take(place) == now
                count[:n] += (~goes_on & (now > 0)).view(np.int8) + table.unknown.take(letter)
                state[:n] = np.where(goes_on, table.to.take(place), table.first.take(letter))
            count += state > 0  # the phrase that the end cuts
            out[:, k] += np.bincount(owner[group], weights=count, minlength=len(symbols)).astype(np.int64)
    return out


def predict(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    letters_col: str | None = None,
    known_col: str | None = None,
) -> DataFrame:
    """`docs` with lang_pred and score: how far the winner is ahead of the second, 0 to 1.

    `letters_col` names a further column, the number of letters: 0 tells texts that no
    model could judge from those that are `und` (or labelled so) for want of one.
    `known_col` names one that tells whether the winner explains the text. Columns of
    `docs` with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only the texts go to Python and only the judgements come back.
    @F.arrow_udf("struct<lang_pred:string,score:double,letters:bigint,known:boolean>")
    def judged(texts: pa.Array) -> pa.Array:
        return _predicted(texts, shared.value)

    judged = judged.asNondeterministic()  # or else a filter on its result runs it again
    others = [c for c in docs.columns if c not in ("lang_pred", "score", letters_col, known_col)]
    # Positions, not names: a column of any name may be passed through.
    passed = docs.select(
        judged(F.col(text_col)).alias("__judged"),
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]).alias("__rest"),
    )
    return passed.select(
        *[F.col(f"__rest.c{i}").alias(c) for i, c in enumerate(others)],
        F.col("__judged.lang_pred").alias("lang_pred"),
        F.col("__judged.score").alias("score"),
        *([F.col("__judged.letters").alias(letters_col)] if letters_col else []),
        *([F.col("__judged.known").alias(known_col)] if known_col else []),
    )


def _predicted(texts: pa.Array, model: Model) -> pa.Array:
    """Language, score, letters and whether the language explains the text, of every text,
    some LETTERS_AT_A_TIME letters at a time."""
    names: list[str] = []
    scores: list[float] = []
    known: list[bool] = []
    letters: list[int] = []
    held: list[np.ndarray] = []
    n_letters: list[int] = []

    def judge() -> None:
        for name, score, fits in zip(*_judged(model, held, n_letters), strict=True):
            names.append(name)
            scores.append(score)
            known.append(fits)
        letters.extend(n_letters)
        held.clear()
        n_letters.clear()

    total = 0
    for text in texts:
        low = folded(code_points(text.as_py() or ""))
        n_letters.append(int(np.count_nonzero(low)))
        held.append(model.symbols[low])
        total += len(low)
        if total >= LETTERS_AT_A_TIME:
            judge()
            total = 0
    judge()
    return pa.StructArray.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array(scores, pa.float64()),
            pa.array(letters, pa.int64()),
            pa.array(known, pa.bool_()),
        ],
        ["lang_pred", "score", "letters", "known"],
    )


def _judged(model: Model, symbols: list[np.ndarray], n_letters: list[int]):
    """Language and score of each document, and whether the language explains it. Phrases
    are weighed by the bits that point at one of the places of the language's text, so that
    texts of unequal size compare."""
    if not symbols or not model.languages:
        return [UNDETERMINED] * len(symbols), [0.0] * len(symbols), [n > 0 for n in n_letters]
    per_phrase = np.log2(np.array(model.lengths, float))
    bits = phrases(model, symbols) * per_phrase[None, :]
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    rest = bits.copy()
    rest[np.arange(len(bits)), best] = np.inf
    second = rest.min(axis=1) if bits.shape[1] > 1 else np.full(len(bits), np.inf)
    ahead = 1.0 - least / second
    some = np.array(n_letters) > 0
    alphabets = np.array([np.count_nonzero(~t.unknown) for t in model.tables])
    spelled = np.fromiter(map(len, symbols), float, len(symbols)) * np.log2(alphabets)[best]
    known = some & (least <= SPELLING_RATIO * spelled + SPARE_PHRASES * per_phrase[best])
    names = [model.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)]
    return names, np.where(some, np.clip(ahead, 0.0, 1.0), 0.0).tolist(), known.tolist()


def split_of(id_col: str) -> Column:
    """Whether a document is held out of learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    letters_col: str | None = None,
    known_col: str | None = None,
    **options,
) -> DataFrame:
    """`docs` with held_out, lang_pred and score (and the number of letters and whether the
    language explains the text, if `letters_col` and `known_col` name these columns),
    learned from those not held out."""
    train = docs.filter(~split_of(id_col))
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    model = fit(train, text_col, label_col, order, **options)
    judged = docs.withColumn("held_out", split_of(id_col))
    return predict(judged, model, text_col, letters_col, known_col)
