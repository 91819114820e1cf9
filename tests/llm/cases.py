"""Awkward documents that every operator has to take, and plain versions of small parts."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that the operators use for their own columns.
    "n_words int, kept_text string, score string, id string, size string, `row` string, hash string, "
    "label string, `group` string, taken string, held_out string, lang_pred string"
)
CLASHING = ("x",) * 11

SYLLABLES = {
    "en": "the and ing tion er with ly that ou sh wh".split(),
    "de": "der und ung keit ich sch ein ver heit ge tz".split(),
    "es": "que de ción mente el los ado ez ar la ñ".split(),
}


def prose(rnd: random.Random, lang: str, n: int) -> str:
    words = ["".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 3))) for _ in range(n)]
    for i in range(9, n, 10):
        words[i] += ".\n" if i % 20 == 9 else ","
    return " ".join(words)


def documents(seed: int = 5, n: int = 60) -> list[tuple]:
    """Ordinary documents of three languages and four sources, a third of them of one source,
    with exact and near copies and a passage of 60 words that several share, then odd ones."""
    rnd = random.Random(seed)
    texts, langs = [], []
    passage = prose(rnd, "en", 60)
    for i in range(n):
        lang = rnd.choice(list(SYLLABLES))
        text = prose(rnd, lang, rnd.choice([25, 60, 120, 200]))
        if i % 9 == 3:
            text = f"{text} {passage} {prose(rnd, lang, 5)}"
        if i % 7 == 6:
            text, lang = texts[i - 5], langs[i - 5]
            if i % 2:
                words = text.split(" ")
                words[rnd.randrange(len(words))] = "changed"
                text = " ".join(words)
        texts.append(text)
        langs.append(lang)
    rows = [
        (i, t, g, rnd.choice(["hot", "hot", "a", "b", "c"]), len(t))
        for i, (t, g) in enumerate(zip(texts, langs, strict=True))
    ]
    long = prose(rnd, "de", 9_000)
    rows += [
        (1000, None, "en", "a", None),
        (1001, "", "en", "a", 0),
        (1002, " \t\r\n\x0b\x0c ", None, None, 7),
        (1003, "word", "en", None, 4),
        (1004, "word", "en", "b", 4),
        (1005, "12345 67890 !!", "en", "b", 14),
        (1006, long, "de", "b", len(long)),
        (1007, long, "de", "c", len(long)),
        (1008, "Ünïcode ñandú 語　 é\U0001f600 <|endoftext|>", "es", "c", 30),
        (1009, "same line\nsame line\nsame line\n\n\n", "en", "c", 30),
        (1010, "a b c d e f g h " * 40, "en", "c", 640),
        (None, texts[0], "en", "a", 10),
        (None, None, None, None, None),
        (5, texts[5], "en", "a", 10),  # repeats an id with its text
        (5, texts[5], "en", "a", 10),
        (1011, "OF!! THE!! " * 30 + "### $$$ &&&", None, "hot", 340),
    ]
    return [(*r, 7, *CLASHING) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
