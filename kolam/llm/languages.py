"""Problem 10: the language of each document and of each stretch of it, by cross-parsing entropy.

A suffix automaton over labelled text of a language knows every substring of it. A sentence is parsed against it: the longest match
from the current place is a phrase, the next one starts behind it. The fewer phrases for its length, the more the sentence is like
the language; phrases are weighed by the logarithm of the automaton's text, as in cross-parsing estimates of entropy. The language
that needs least wins, and the distance to the second is the confidence.

Labels are wrong at times, so the text is tried first: each half of the labelled sentences is parsed by automata of the other half,
and only sentences that come out as their label stay. A language written in two scripts has an automaton for each; one that keeps
too small a part of its sentences is dropped as mislabelled text of other languages.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.scratch import local_table

# Two-letter codes and the other names that labels use for them.
LANGUAGES = {
    "en": ("eng", "english"), "te": ("tel", "telugu"), "hi": ("hin", "hindi"), "ta": ("tam", "tamil"), "es": ("spa", "spanish"),
    "pt": ("por", "portuguese"), "fr": ("fra", "fre", "french"), "de": ("deu", "ger", "german"),
}
#: A sentence ends behind these signs where white space follows, or at a line's end.
_ENDS = re.compile(r"[^\n]*?(?:[.!?।॥…。！？]+[\"'”’»)\]]*(?=\s)|(?=\n)|\Z)", re.S)
_LONGEST = 600  # longer sentences are judged in pieces of about so many characters, cut at white space


def label_language(c) -> Column:
    """The two-letter code that a label names: by a two- or three-letter code or an English name, in any case, with or without a
    region; null for any other label."""
    c = F.col(c) if isinstance(c, str) else c
    word = F.regexp_extract(F.lower(F.trim(F.regexp_replace(c, r"[ \t]+", " "))), r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    names = [F.lit(x) for code, others in LANGUAGES.items() for name in (code, *others) for x in (name, code)]
    return F.create_map(*names)[word]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text that are not blank, whole and in order."""
    out = []
    for m in _ENDS.finditer(text):
        a, b = m.span()
        while a < b and text[a].isspace():
            a += 1
        while b - a > _LONGEST:
            cut = next((i for i in range(a + _LONGEST, max(a + 1, a + _LONGEST // 2), -1) if text[i].isspace()), a + _LONGEST)
            out.append((a, cut))
            a = cut
            while a < b and text[a].isspace():
                a += 1
        if b > a:
            out.append((a, b))
    return out


@lru_cache(1 << 15)
def _script_of(ch: str) -> str:
    """The script of a letter or mark, empty for all else."""
    name = unicodedata.name(ch, "?").split()[0].split("-")[0] if unicodedata.category(ch)[0] in "LM" else ""
    return "" if name == "COMBINING" else name


def in_script(s: str, script: str) -> str:
    """The text without letters of other scripts, as words of another language that are only quoted."""
    if s.isascii():
        return s
    foreign = {ord(ch): None for ch in set(s) if _script_of(ch) not in ("", script)}
    return s.translate(foreign) if foreign else s


def main_script(s: str) -> str:
    """The script of most of the letters; empty without letters."""
    if s.isascii():
        return "LATIN" if any(map(str.isalpha, s)) else ""
    seen: dict[str, int] = {}
    for ch in s:
        if name := _script_of(ch):
            seen[name] = seen.get(name, 0) + 1
    return max(sorted(seen), key=seen.get) if seen else ""


class Automaton:
    """A suffix automaton of a bounded text, with its transitions as one dense table so that many sentences are parsed in step."""

    def __init__(self, text: str):
        symbols = {ch: i + 1 for i, ch in enumerate(sorted(set(text) - {"\n"}))}  # 0: any other character, never matched
        self.lookup = dict(symbols)
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            s = symbols.get(ch, 0)
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and s not in nxt[p]:
                nxt[p][s] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][s]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(s) == q:
                        nxt[p][s] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.table = np.full((len(nxt), len(symbols) + 1), -1, np.int32)
        for state, row in enumerate(nxt):
            for s, to in row.items():
                if s:
                    self.table[state, s] = to
        self.log_size = float(np.log2(max(2, len(text))))

    def __getstate__(self):  # what is sent to the workers holds the transitions only
        used = np.flatnonzero(self.table.ravel() >= 0)
        return {"lookup": self.lookup, "log_size": self.log_size, "shape": self.table.shape, "at": used.astype(np.int32), "to": self.table.ravel()[used]}

    def __setstate__(self, kept):
        self.lookup, self.log_size = kept["lookup"], kept["log_size"]
        self.table = np.full(kept["shape"], -1, np.int32)
        self.table.ravel()[kept["at"]] = kept["to"]

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases needed by each of the sentences, the rows of codes (code points, longest first, padded at the end)."""
        points = np.zeros(0x110000, np.uint8 if len(self.lookup) < 255 else np.int32)
        for ch, s in self.lookup.items():
            points[ord(ch)] = s
        n, width = codes.shape
        state, count = np.zeros(n, np.int64), np.ones(n, np.int64)
        flat, symbols = self.table.ravel(), self.table.shape[1]
        alive = np.searchsorted(-lengths, -np.arange(width), side="left")  # how many are longer than j
        by_place = np.ascontiguousarray(points[codes].T)
        for j in range(width):
            m = alive[j]
            s = by_place[j, :m]
            to = flat[state[:m] * symbols + s]
            fail = to < 0
            if fail.any():
                again = flat[s[fail].astype(np.int64)]  # from the root
                count[:m][fail] += state[:m][fail] != 0
                unknown = again < 0
                again[unknown] = 0
                to[fail] = again
                idx = np.flatnonzero(fail)[unknown]
                count[idx] += 1  # a character the text doesn't have is a phrase of its own
            state[:m] = to
        return count - (state == 0)


def _coded(low: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, code points, lengths) of sentences for Automaton.phrases: rows in that order, longest first."""
    lengths = np.array([len(t) for t in low])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    codes = np.full((len(low), int(lengths[0])), 10, np.int32)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = np.frombuffer("".join(low[i] for i in order).encode("utf-32-le", "surrogatepass"), np.int32)
    return order, codes, lengths


class Languages:
    """Automata by (language, script)."""

    def __init__(self, texts: dict[tuple[str, str], str]):
        self.models = {k: Automaton(t) for k, t in sorted(texts.items())}

    def judge(self, found: list[str], weighed: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(language, confidence from 0 to 1) of each sentence; und and 0 where no language's letters are in it."""
        lang, sure = np.full(len(found), "und", object), np.zeros(len(found))
        scripts = np.array([main_script(s) for s in found], object)
        for script in set(scripts) - {""}:
            rivals = [(k[0], m) for k, m in self.models.items() if k[1] == script]
            idx = np.flatnonzero(scripts == script)
            if not rivals:
                continue
            order, codes, lengths = _coded([in_script(found[i], script).lower() for i in idx])
            idx = idx[order]
            costs = np.array([m.phrases(codes, lengths) * (m.log_size if weighed else 1.0) / lengths for _, m in rivals])
            best = costs.argmin(axis=0)
            least = costs.min(axis=0)
            if len(rivals) > 1:
                second = np.partition(costs, 1, axis=0)[1]
            else:
                second = np.full(len(idx), rivals[0][1].log_size)
            lang[idx] = np.array([r[0] for r in rivals], object)[best]
            sure[idx] = np.clip(1 - least / np.maximum(second, 1e-9), 0, 1)
        return lang, sure


def fit_languages(documents: DataFrame, text: str = "text", label: str = "lang", sample_documents: int = 6_000, sample_sentences: int = 24_000, sample_chars: int = 40_000, trial_chars: int = 100_000, least_kept: float = 0.15, least_sure: float = 0.5) -> Languages:
    """Automata of the labelled text of documents, from a bounded sample.

    sample_documents and sample_sentences bound what is sampled, by hash, and comes to the driver; trial_chars bounds an automaton of
    the trials and sample_chars one of the result. least_kept: the part of a language's sentences in a script that must come out as
    labelled, else it has no automaton for that script. In the trials the automata are as large as the labels are frequent and
    phrases aren't weighed, so that a few mislabelled sentences don't win against the many of their true language. A sentence
    whose confidence is less than least_sure of its language's median stays out, at least until a later trial, when the other
    language has lost what is like it. Without labelled
    text there are no automata, and all text is und.
    """
    labelled = documents.select(F.col(text).alias("t"), label_language(label).alias("l")).where(F.col("l").isNotNull() & F.col("t").isNotNull())
    share = sample_documents / max(1, labelled.count())
    some = labelled.where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < share * (1 << 30))

    def split(batches):
        for p in batches:
            rows = [(l, t[a:b]) for t, l in zip(p["t"], p["l"]) for a, b in sentences(t)]
            if rows:
                yield pd.DataFrame(rows, columns=["l", "s"], dtype=object)

    found = some.mapInPandas(split, "l string, s string").where(F.length("s") >= 12).distinct()
    rows = found.orderBy(F.xxhash64("s"), "s", "l").limit(sample_sentences).toPandas()
    rows["script"] = rows["s"].map(main_script)
    rows = rows[rows["script"] != ""].reset_index(drop=True)
    kept = np.ones(len(rows), bool)
    half = (np.arange(len(rows)) % 2).astype(bool)
    shared = documents.sparkSession.sparkContext.broadcast((rows, half))
    for _ in range(3):
        came, sure = _trial(documents.sparkSession, shared, kept, trial_chars)
        right = came == rows["l"].to_numpy()
        for _, idx in rows.groupby(["l", "script"]).groups.items():
            ok = right[idx]
            kept[idx] = ok & (ok.mean() >= least_kept) & (sure[idx] >= least_sure * (np.median(sure[idx][ok]) if ok.any() else 1.0))
    return Languages(_sample(rows[kept], sample_chars))


def _trial(spark: SparkSession, shared, kept: np.ndarray, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(language, confidence) of each sampled sentence by the automata of the other half's kept ones, phrases not weighed: a task for
    each half and automaton, which gives its cost of every sentence in its script."""
    rows, half = shared.value
    b_kept = spark.sparkContext.broadcast(kept)
    models = rows[["l", "script"]].assign(half=half)[kept].drop_duplicates()
    tasks = local_table(spark, [(bool(~np.bool_(r["half"])), r["l"], r["script"]) for r in models.to_dict("records")], "side boolean, l string, script string")

    def cost(batches):
        rows, half = shared.value
        for p in batches:
            for side, lang, script in zip(p["side"], p["l"], p["script"]):
                own = b_kept.value & (half != side) & (rows["l"].to_numpy() == lang) & (rows["script"].to_numpy() == script)
                model = Automaton(_sample(rows[own], chars)[(lang, script)])
                idx = np.flatnonzero((half == side) & (rows["script"].to_numpy() == script))
                if len(idx):
                    order, codes, lengths = _coded([in_script(rows["s"].iloc[i], script).lower() for i in idx])
                    yield pd.DataFrame({"i": idx[order], "l": lang, "cost": model.phrases(codes, lengths) / lengths, "size": model.log_size})

    got = tasks.repartition(max(1, len(models))).mapInPandas(cost, "i long, l string, cost double, size double").toPandas()  # sampled sentences x languages
    got = got.sort_values(["i", "cost", "l"]).reset_index(drop=True)
    came, sure = np.full(len(rows), "und", object), np.zeros(len(rows))
    first = got.groupby("i").head(1).set_index("i")
    second = got.groupby("i").nth(1).set_index("i")["cost"].reindex(first.index).fillna(first["size"])  # without a rival, the dearest there is
    came[first.index] = first["l"]
    sure[first.index] = np.clip(1 - first["cost"] / np.maximum(second, 1e-9), 0, 1)
    return came, sure


def _sample(rows: pd.DataFrame, chars: int) -> dict[tuple[str, str], str]:
    out = {}
    for key, own in rows.groupby(["l", "script"]):
        text, size = [], 0
        for s in own["s"]:
            text.append(in_script(s, key[1]).lower())
            size += len(s) + 1
            if size >= chars:
                break
        out[key] = "\n".join(text)
    return out


def language_segments(documents: DataFrame, languages: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, segment, start, end, lang, confidence): the stretches of each document in one language, in order.

    start and end are characters of the text. Sentences without letters join the stretch before them, or the next one at the start;
    a document without any letters is one stretch of und, confidence 0. A stretch's confidence is the mean of its sentences' by
    length. Null and blank texts give no rows; repeated documents give rows each.
    """
    shared = documents.sparkSession.sparkContext.broadcast(languages)
    kind = dict(documents.dtypes)[key]

    def segment(batches):
        for p in batches:
            at: list[tuple] = []
            texts: list[str] = []
            for n, t in enumerate(p["t"]):
                spans = sentences(t)
                at += [(n, a, b) for a, b in spans]
                texts += [t[a:b] for a, b in spans]
                if len(texts) >= 20_000:
                    yield stretches(p["k"], at, *shared.value.judge(texts))
                    at, texts = [], []
            if texts:
                yield stretches(p["k"], at, *shared.value.judge(texts))

    def stretches(keys, at, lang, sure):
        out: list[list] = []  # document, start, end, language, weighted confidence, weight
        for (n, a, b), l, c in zip(at, lang, sure):
            same = out and out[-1][0] == n
            if same and (l == out[-1][3] or l == "und" or out[-1][3] == "und"):
                last = out[-1]
                last[2] = b
                last[3] = l if last[3] == "und" else last[3]
                last[4] += c * (b - a)
                last[5] += b - a
            else:
                out.append([n, a, b, l, c * (b - a), b - a])
        p = pd.DataFrame(out, columns=["n", "start", "end", "lang", "c", "w"])
        return pd.DataFrame({key: keys.iloc[p["n"].to_numpy()].to_numpy(), "segment": p.groupby("n").cumcount(), "start": p["start"], "end": p["end"], "lang": p["lang"].astype(object), "confidence": p["c"] / p["w"]})

    given = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    return given.mapInPandas(segment, f"{key} {kind}, segment long, start long, end long, lang string, confidence double")


def document_language(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, lang, confidence) of each document: the language of most of its characters, its confidence times its share."""
    per = segments.groupBy(key, "lang").agg(F.sum(F.col("end") - F.col("start")).alias("w"), F.sum((F.col("end") - F.col("start")) * F.col("confidence")).alias("c"))
    top = per.groupBy(key).agg(F.max(F.struct("w", "lang", "c")).alias("m"), F.sum("w").alias("all"))
    return top.select(key, F.col("m.lang").alias("lang"), (F.col("m.c") / F.col("all")).alias("confidence"))
