"""Problem 6: one form for texts that look the same but differ in characters.

For each token (a run of non-spaces) the sets of scripts its letters could be written in are intersected: a letter's own script and
the scripts that hold a look-alike of it. A token whose own scripts don't meet is mixed-script; one whose letters all have
look-alikes in the text's script is a whole-script confusable. In both cases the spelling in the consistent script is selected: the
text's main script if the intersection holds it, else one of the token. What remains is brought to one form: full-width and other
width variants, fonts, ligatures, spaces, invisible characters, hyphens, order and composition of accents. Letter case, visible
accents and compatibility forms that look different (as superscripts) stay.

The look-alikes are those of the published Unicode confusables list, which the ICU library among Spark's own jars holds: letters of
any left-to-right script with a Latin letter of the same skeleton, and Kannada signs with a Telugu one. The lists below come before
it and serve where there is no session. Letters of one script that resemble each other (l and I) stay what they are.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Telugu letters, signs and digits whose Kannada counterparts look the same. The two blocks are laid out alike, so
# the counterpart is the character 0x80 further on.
_TELUGU_LIKE_KANNADA = "ంఃఅఆఇఒఓఔజఞణయఱలా౦౧౨౯".replace("ా", "")
# Letters of other scripts and the Latin letters that look the same.
_CYRILLIC = dict(zip("аеорсухѕіјһԁԛԝАВЕКМНОРСТУХЅІЈԌӏӀ", "aeopcyxsijhdqwABEKMHOPCTYXSIJGlI"))
_GREEK = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϳ", "ovABEZHIKMNOPTYXj"))
_ARMENIAN = dict(zip("օսցհԼՍՕ", "oughLUO"))
#: (letter, its script, look-alike, that one's script)
_LISTED = [(chr(ord(t) + 0x80), "KANNADA", t, "TELUGU") for t in _TELUGU_LIKE_KANNADA]
_LISTED += [(o, script, l, "LATIN") for script, table in (("CYRILLIC", _CYRILLIC), ("GREEK", _GREEK), ("ARMENIAN", _ARMENIAN)) for o, l in table.items()]
_HYPHENS = {"‐": "-", "‑": "-", "﹣": "-"}
_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff]")
#: A text of only these needs no work: ASCII without control characters, precomposed Latin letters, and Telugu without length marks.
_PLAIN = "\\x20-\\x7E\\u00C0-\\u00D6\\u00D8-\\u00F6\\u00F8-\\u0131\\u0134-\\u013E\\u0141-\\u0148\\u014A-\\u017E\\u1E00-\\u1E99\\u1EA0-\\u1EF9\\u0C00-\\u0C54\\u0C58-\\u0C7F"


@lru_cache(1 << 16)
def _named_script(ch: str) -> str:
    return unicodedata.name(ch, "UNKNOWN").split()[0].split("-")[0]


@lru_cache(1 << 16)
def _simple(ch: str) -> str:
    """Width and font variants, ligatures, Roman numeral signs, hyphens and spaces in their plain form."""
    if ch in _HYPHENS:
        return _HYPHENS[ch]
    if ch.isspace() or unicodedata.category(ch)[0] == "Z":
        return " "
    how = unicodedata.decomposition(ch)
    if how.startswith(("<wide>", "<narrow>", "<font>", "<noBreak>")) or how and (0xFB00 <= ord(ch) <= 0xFB06 or 0x2160 <= ord(ch) <= 0x217F):
        return unicodedata.normalize("NFKC", ch)
    return ch


_EASY = re.compile(f"[{_PLAIN}]*")
_LATIN, _TELUGU = re.compile("[A-Za-z\u00C0-\u024F\u1E00-\u1EFF]"), re.compile("[\u0C00-\u0C7F]")


class LookAlikes:
    """Which letters look like which, and the form of texts by it. pairs: (letter, script, look-alike, script); of a letter's several
    look-alikes in one script the first counts, in both directions."""

    def __init__(self, pairs: list[tuple[str, str, str, str]]):
        self.to: dict[str, dict[str, str]] = {}
        for a, of_a, b, of_b in pairs:
            self.to.setdefault(a, {}).setdefault(of_b, b)
            self.to.setdefault(b, {}).setdefault(of_a, a)
        self._scripts: dict[str, str] = {}
        self._tokens: dict[tuple[str, str], str] = {}

    def __getstate__(self):
        return {"to": self.to, "_scripts": {}, "_tokens": {}}

    def script(self, ch: str) -> str:
        """The script of a letter or mark, by its name's first word; empty for what belongs to all scripts."""
        got = self._scripts.get(ch)
        if got is None:
            kind = unicodedata.category(ch)
            if kind[0] == "M" and unicodedata.name(ch, "").startswith("COMBINING"):
                got = ""
            else:
                got = _named_script(ch) if kind[0] in "LM" or ch in self.to else ""
            self._scripts[ch] = got
        return got

    def _token_form(self, token: str, main: str) -> str:
        known = self._tokens.get((token, main))
        if known is None:
            if len(self._tokens) >= 1 << 16:
                self._tokens.clear()
            known = self._tokens[(token, main)] = self._spelled(token, main)
        return known

    def _spelled(self, token: str, main: str) -> str:
        script, to = self.script, self.to
        own = {s for s in map(script, token) if s}
        if not own or own == {main}:
            return token
        could: set[str] | None = None
        for ch in token:
            if s := script(ch):
                can = {s, *to.get(ch, ())}
                could = can if could is None else could & can
        if not could or (len(own) == 1 and main not in could):
            return token  # no script can spell it, or it is consistent in a script of its own
        best = main if main in could else max(sorted(could & own) or sorted(could), key=lambda s: sum(script(c) == s for c in token))
        return "".join(ch if script(ch) in ("", best) else to[ch][best] for ch in token)

    def form(self, text: str | None) -> str | None:
        """The one form of a text; null for null. Two texts look the same if their forms are equal. Applying it twice changes nothing."""
        if text is None or _EASY.fullmatch(text) and (text.isascii() or not (_LATIN.search(text) and _TELUGU.search(text))):
            return text
        text = "".join(map(_simple, _INVISIBLE.sub("", text)))
        # A new spelling may make another script the main one: until nothing changes, or the least of the spellings that take turns.
        met = [unicodedata.normalize("NFC", text)]
        while (now := self._consistent(met[-1])) not in met:
            met.append(now)
        return min(met[met.index(now) :])

    def _consistent(self, text: str) -> str:
        script, to = self.script, self.to
        text = unicodedata.normalize("NFD", text)
        seen: dict[str, int] = {}
        for ch in text:
            if s := script(ch):
                seen[s] = seen.get(s, 0) + 1
        # letters without look-alikes in the text's other scripts (of a text in one script: in Latin and Telugu) show the main script
        rivals = set(seen) if len(seen) > 1 else {"LATIN", "TELUGU"}
        firm: dict[str, int] = {}
        for ch in text if seen else ():
            if (s := script(ch)) and not any(r != s and r in to.get(ch, ()) for r in rivals):
                firm[s] = firm.get(s, 0) + 1
        if len(seen) > 1 or seen and not firm:
            # a text without any is spelled in Latin or Telugu where it can be
            main = max(sorted(firm), key=firm.get) if firm else next((s for s in ("LATIN", "TELUGU") if all(s in (script(c), *to.get(c, ())) for c in text if script(c))), max(sorted(seen), key=seen.get))
            text = re.sub(r"[^ ]+", lambda m: self._token_form(m[0], main), text)
        return unicodedata.normalize("NFC", text)


LISTED = LookAlikes(_LISTED)
_known: dict[str, LookAlikes] = {}


def published_pairs(spark: SparkSession) -> list[tuple[str, str, str, str]]:
    """The look-alikes of the confusables list that matter here, in order of code points.

    A letter and a Latin one pair up if the list gives both the same skeleton; where several Latin letters share it, one of the same
    case counts, of letters without case the capital. Right-to-left letters and those that have a plain form anyway are left out.
    """
    letters = [ch for ch in map(chr, range(0x80, 0x20000)) if unicodedata.category(ch)[0] == "L" and unicodedata.bidirectional(ch) == "L" and _simple(ch) == unicodedata.normalize("NFD", ch) == ch and not 0x3400 <= ord(ch) <= 0x9FFF]
    latin = [ch for ch in map(chr, range(0x41, 0x7B)) if ch.isalpha()]
    blocks = [chr(c) for c in range(0x0C00, 0x0D00) if unicodedata.category(chr(c)) != "Cn"]  # Telugu, then Kannada
    every = latin + letters + blocks
    skeleton = dict(zip(every, spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton(0, "\n".join(every)).split("\n")))
    same: dict[str, list[str]] = {}
    for ch in latin:
        same.setdefault(skeleton[ch], []).append(ch)
    out = []
    for ch in letters:
        of = _named_script(ch)
        if of not in ("LATIN", "MODIFIER", "UNKNOWN") and (like := same.get(skeleton[ch])):
            out.append((ch, of, next((x for x in like if x.islower() == ch.islower()), like[0]), "LATIN"))
    kannada: dict[str, str] = {}
    for ch in blocks:
        if ord(ch) >= 0x0C80:
            kannada.setdefault(skeleton[ch], ch)
    return out + [(kannada[skeleton[t]], "KANNADA", t, "TELUGU") for t in blocks if ord(t) < 0x0C80 and skeleton[t] in kannada and unicodedata.category(t) == unicodedata.category(kannada[skeleton[t]])]


def look_alikes(spark: SparkSession) -> LookAlikes:
    """The listed look-alikes and the published ones; made once per application."""
    app = spark.sparkContext.applicationId
    if app not in _known:
        _known[app] = LookAlikes(_LISTED + published_pairs(spark))
    return _known[app]


def same_look(text: str | None) -> str | None:
    """The form of a text by the listed look-alikes only."""
    return LISTED.form(text)


def same_look_column(c, spark: SparkSession | None = None) -> Column:
    """The form of a string column by all look-alikes. Texts that are plain by one regular expression stay in the JVM; only the
    others reach Python."""
    looks = look_alikes(spark or SparkSession.getActiveSession())

    @F.pandas_udf(StringType())
    def formed(s: pd.Series) -> pd.Series:
        return s.map(looks.form, na_action="ignore").where(s.notna(), None)

    c = F.col(c) if isinstance(c, str) else c
    odd = c.rlike(f"[^{_PLAIN}]") | (c.rlike("[A-Za-z\\u00C0-\\u024F\\u1E00-\\u1EFF]") & c.rlike("[\\u0C00-\\u0C7F]"))
    return F.coalesce(formed(F.when(odd, c)), c)
