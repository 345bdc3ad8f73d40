"""Actor names in captions: putting them in, and taking back wrong uses.

A caption is read as a list of tokens.  The names and the people in it are
mentions, and what stands right before a mention decides whether it can be the
person named before.  The names differ from row to row, so this runs as one Arrow-batched
function per rule set instead of native expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOUN = {"male": "man", "female": "woman"}

# Garments that contradict the known gender of the person named before them.
FEMALE_ATTIRE = ["saree", "sari", "lehenga", "ghagra", "choli", "blouse", "dupatta", "bindi", "jhumka", "jhumki", "mangalsutra", "anklet", "payal", "nath", "nose ring", "maang tikka", "bridal"]
MALE_ATTIRE = ["sherwani", "kurta pajama", "dhoti", "lungi", "turban", "pagri", "safa"]

# What stands between a person and a second one.
PLACES = ["beside", "next to", "in front of", "opposite", "across from", "alongside"]
MEETINGS = ["talking to", "talking with", "speaking to", "speaking with", "conversing with", "chatting with", "shakes hands with", "hug", "hugs", "hugging", "embrace", "embraces", "embraced", "embracing", "kisses", "kissing"]
DOINGS = ["facing", "with", "joins", "greets", "confronts", "approaches", "chatting to"]
TALKS = ["speak to", "speak with", "speaks to", "speaks with", "conversation with", "interaction with", "argument with", "argue with", "argues with", "arguing with", "confronts", "confronting", "confrontation with", "facing", "embrace with", "embraces with", "embracing with"]
SECONDS = ["another", "a second", "the other"]
BETWEEN = ["and", "with", "beside", "opposite", "facing", "next to", "alongside", "to his left", "to his right", "to her left", "to her right", "in front of", "behind"]
DESCRIBED = ["who", "whom", "leaning", "sitting", "seated", "standing", "wearing", "dressed", "in a", "in an", "in his", "in her", "behind", "opposite", "beside"]
#: Characters after a name in which a garment belongs to it; from a name to what ties it to the next one, and from there to that one.
ATTIRE_REACH, TIE_REACH, TIE_GAP = 60, 90, 15


class Token(NamedTuple):
    word: str  # in lower case
    start: int
    end: int


_TOKEN = re.compile(r"[^\W_]+|\n|[^\w\s]|_")


def tokens(text: str) -> list[Token]:
    """Words, marks and line ends with their places."""
    return [Token(m[0].lower(), *m.span()) for m in _TOKEN.finditer(text)]


def _split(phrases: list[str]) -> dict[tuple[str, ...], str]:
    return {tuple(t.word for t in tokens(p)): p for p in phrases}


_WOMENS, _MENS = _split(FEMALE_ATTIRE), _split(MALE_ATTIRE)
_PLACES, _MEETINGS, _SECONDS, _BETWEEN, _DESCRIBED = (_split(x) for x in (PLACES, MEETINGS, SECONDS, BETWEEN, DESCRIBED))
#: Leads that show a second person to a reader, and those that are enough for a repair where only one person is known.
_SEEN, _ALONE = _split(PLACES + MEETINGS + DOINGS), _split(PLACES + MEETINGS + TALKS)


def _ends(ts: list[Token], k: int, phrases: dict[tuple[str, ...], str]) -> int:
    """Tokens of the longest of the phrases that ends right before token k; 0 for none."""
    return max((len(p) for p in phrases if len(p) <= k and tuple(t.word for t in ts[k - len(p) : k]) == p), default=0)


def _begins(ts: list[Token], k: int, phrases: dict[tuple[str, ...], str]) -> int:
    """Tokens of the longest of the phrases that begins with token k; 0 for none."""
    return max((len(p) for p in phrases if tuple(t.word for t in ts[k : k + len(p)]) == p), default=0)


class Mention(NamedTuple):
    """Tokens first to last - 1 are a name."""

    first: int
    last: int


def mentions_of(ts: list[Token], name: str) -> list[Mention]:
    want = tuple(t.word for t in tokens(name))
    out, k = [], 0
    while want and k + len(want) <= len(ts):
        if tuple(t.word for t in ts[k : k + len(want)]) == want:
            out.append(Mention(k, k + len(want)))
            k += len(want)
        else:
            k += 1
    return out


def _before_object(ts: list[Token], k: int) -> tuple[int, str]:
    """Where the object right before token k begins, and its kind: pronoun, noun (``the`` and a word) or none."""
    if k and ts[k - 1].word in ("him", "her", "them"):
        return k - 1, "pronoun"
    if k > 1 and ts[k - 2].word == "the" and ts[k - 1].word.isalnum():
        return k - 2, "noun"
    return k, "none"


def _led(ts: list[Token], m: Mention, phrases: dict[tuple[str, ...], str]) -> bool:
    """Whether one of the phrases leads to the mention, with or without an object between."""
    return bool(_ends(ts, m.first, phrases) or _ends(ts, _before_object(ts, m.first)[0], phrases))


def _surely_second(ts: list[Token], m: Mention) -> bool:
    """A meeting right before the mention, or a place that is already taken by a pronoun."""
    comma = m.first - 1 if m.first and ts[m.first - 1].word == "," else m.first
    at, kind = _before_object(ts, comma)
    return bool(_ends(ts, m.first, _MEETINGS)) or (kind == "pronoun" and bool(_ends(ts, at, _PLACES)))


def _alone_second(ts: list[Token], m: Mention) -> bool:
    """Where only one person is known: any tie to the mention, or ``with`` before it and a description behind it."""
    behind = m.last + (m.last < len(ts) and ts[m.last].word == ",")
    return _led(ts, m, _ALONE) or (m.first > 0 and ts[m.first - 1].word == "with" and _begins(ts, behind, _DESCRIBED) > 0)


def _doubled(ts: list[Token], name: str) -> Iterator[Mention]:
    """Mentions that ``and`` ties to one of the same name right before."""
    found = mentions_of(ts, name)
    for a, b in zip(found, found[1:], strict=False):
        if b.first == a.last + 1 and ts[a.last].word in ("and", "&"):
            yield b


def slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def genders(names: list[str], known: dict[str, str], faces: list[dict] | None = None) -> list[str | None]:
    """male, female or None of each name: from the known map, else from a face of that name."""
    short = {"m": "male", "f": "female", "male": "male", "female": "female"}
    fixed = {slug(k): short[g.strip().lower()] for k, g in known.items() if g and g.strip().lower() in short}
    seen: dict[str, str] = {}
    for f in faces or []:
        g = str(f.get("face_gender") or "").strip().lower()
        if g in NOUN:
            for key in ("actor", "display_name"):
                seen.setdefault(slug(str(f.get(key) or "")), g)
    return [fixed.get(slug(n)) or seen.get(slug(n)) for n in names]


def _other(gender: str | None) -> str:
    return "another " + NOUN.get(gender or "", "person")


def _replaced(text: str, changes: list[tuple[int, int, str]]) -> str:
    """Text with the spans replaced; a new text at the start of a sentence begins with a capital letter."""
    out, at = [], 0
    for start, end, new in sorted(changes):
        before = text[:start].rstrip(" \t")
        out += [text[at:start], new[:1].upper() + new[1:] if not before or before[-1] in ".!?\n" else new]
        at = end
    return "".join([*out, text[at:]])


def _others(text: str, ts: list[Token], found: list[Mention], gender: str | None) -> str:
    return _replaced(text, [(ts[m.first].start, ts[m.last - 1].end, _other(gender)) for m in found])


def _swap(text: str, table: dict[str, str], once: bool = False) -> str:
    """Phrases of the table (written small, or with a capital first letter) replaced from left to right, all or the first one."""
    ts, phrases = tokens(text), _split(list(table))
    changes, k = [], 0
    while k < len(ts) and not (once and changes):
        n = _begins(ts, k, phrases)
        old = text[ts[k].start : ts[k + n - 1].end] if n else ""
        if n and old[1:].islower():
            new = table[phrases[tuple(t.word for t in ts[k : k + n])]]
            changes.append((ts[k].start, ts[k + n - 1].end, new[:1].upper() + new[1:] if old[0].isupper() else new))
        k += n or 1
    return _replaced(text, changes)


def put_names(caption: str, names: list[str], of: list[str | None]) -> str:
    """Use the identified names where the caption speaks of people in general.

    One name: couples become the name and another person; where there is none, the first phrase that
    fits the gender becomes the name.  One man and one woman: phrases go by
    gender.  Otherwise: the first two names stand for women and men as they occur.
    """
    if not caption or not names:
        return caption
    kinds = {g: [n for n, x in zip(names, of, strict=True) if x == g] for g in NOUN}
    if len(names) == 1:
        name, gender = names[0], of[0]
        pairs = _swap(caption, dict.fromkeys(["two women", "two men", "two individuals", "a couple"], f"{name} and {_other(gender)}"))
        people = [NOUN[gender]] if gender else list(NOUN.values())
        single = [f"{a} {n}" for n in people for a in ("the", "a", "another")] + ["the person", "a person"]
        return repeat_names(_swap(caption, dict.fromkeys(single, name), once=True) if pairs == caption else pairs, name, gender)
    mixed = len(kinds["male"]) == len(kinds["female"]) == 1
    woman, man = (kinds["female"][0], kinds["male"][0]) if mixed else names[:2]
    pair = f"{woman} and {man}"
    table = {f"{a} {n}": who for n, who in (("man", man), ("woman", woman)) for a in ("the", "a", "another")}
    table |= {"two women": pair, "two individuals": pair, "a couple": pair, "both women": f"both {pair}", "the other": man}
    if not mixed:
        table |= {"one wears": f"{woman} wears", "another woman": man}
    return _swap(caption, table)


def repeat_names(text: str, name: str, gender: str | None) -> str:
    """``Name and Name`` as the name and another person, of the known gender."""
    ts = tokens(text)
    text = _others(text, ts, list(_doubled(ts, name)), gender)
    if gender not in NOUN:
        return text
    ts = tokens(text)
    unknown = [m.last for m in mentions_of(ts, name) if tuple(t.word for t in ts[m.last : m.last + 3]) == ("and", "another", "person")]
    return _replaced(text, [(ts[k + 1].start, ts[k + 2].end, _other(gender)) for k in unknown])


def fit_attire(text: str, name: str, gender: str | None) -> str:
    """A name right before garments of the other gender belongs to somebody else."""
    if gender not in NOUN:
        return text
    ts, wrong = tokens(text), _WOMENS if gender == "male" else _MENS
    changes = []
    for m in mentions_of(ts, name):
        reach = ts[m.last - 1].end + ATTIRE_REACH
        for k in range(m.last, len(ts)):
            n = _begins(ts, k, wrong)
            if n and ts[k + n - 1].end <= reach:
                changes.append((ts[m.first].start, ts[m.last - 1].end, "a " + NOUN["female" if gender == "male" else "male"]))
                break
            if ts[k].end > reach:
                break
    return _replaced(text, changes)


def over_tagged(caption: str, names: list[str]) -> bool:
    """Whether a name stands for a second person too."""
    ts = tokens(caption)
    return any(any(True for _ in _doubled(ts, n)) or any(_led(ts, m, _SEEN) or _ends(ts, m.first, _SECONDS) for m in mentions_of(ts, n)[1:]) for n in names)


def meets_self(caption: str, names: list[str]) -> bool:
    """Whether the only identified person interacts with somebody of the same name."""
    if len(names) != 1:
        return False
    ts = tokens(caption)
    found = mentions_of(ts, names[0])
    for a, b in zip(found, found[1:], strict=False):
        for k in range(a.last, b.first):
            n = _begins(ts, k, _BETWEEN)
            if n and k + n <= b.first and ts[k].start - ts[a.last - 1].end <= TIE_REACH and ts[b.first].start - ts[k + n - 1].end <= TIE_GAP:
                return True
    return False


def untag(caption: str, names: list[str], of: list[str | None]) -> str:
    """Later uses of a name that surely mean a second person become another person; the first one stays."""
    second = _alone_second if len(names) == 1 else _surely_second
    for name, gender in zip(names, of, strict=True):
        caption = repeat_names(caption, name, gender)
        ts = tokens(caption)
        caption = _others(caption, ts, [m for m in mentions_of(ts, name)[1:] if second(ts, m)], gender)
    return caption


def targeted(caption: str, names: list[str], of: list[str | None]) -> str:
    """Correct wrong uses of names only, and the words ``the another``."""
    for name, gender in zip(names, of, strict=True):
        caption = fit_attire(repeat_names(caption, name, gender), name, gender)
    return _swap(caption, {"the another": "the other"})


def repair_names(df: DataFrame, caption: str, names: str, gender: Column, *, how: str = "enforce") -> DataFrame:
    """Add ``<caption>_fixed`` and ``over_tagged``.

    ``names`` is an array of display names, ``gender`` an array of the same
    length with male, female or null.  how: enforce (put names in, then fit
    attire), targeted (correct wrong uses only) or untag.  A null caption gives null, null or
    no names leave it as it is.
    """

    def fix(text: str, who: list[str], of: list[str | None]) -> str:
        if how == "targeted":
            return targeted(text, who, of)
        if how == "untag":
            return untag(text, who, of)
        text = put_names(text, who, of)
        for n, g in zip(who, of, strict=True):
            text = fit_attire(text, n, g)
        return text

    def run(texts: pd.Series, whos: pd.Series, ofs: pd.Series) -> pd.DataFrame:
        out = []
        for t, w, g in zip(texts, whos, ofs, strict=True):
            w = [] if w is None else list(dict.fromkeys(x for x in w if x))
            g = [x if x in NOUN else None for x in (list(g) if g is not None else [])][: len(w)]
            g += [None] * (len(w) - len(g))
            out.append((t, None) if t is None else (fix(t, w, g), over_tagged(t, w) or meets_self(t, w)))
        return pd.DataFrame(out, columns=["fixed", "over"])

    r = F.pandas_udf(run, "fixed string, over boolean")(F.col(caption), F.col(names), gender)
    return df.withColumn("__r", r).withColumns({f"{caption}_fixed": F.col("__r.fixed"), "over_tagged": F.col("__r.over")}).drop("__r")
