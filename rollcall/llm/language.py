"""Language of texts, and of spans in mixed texts.

Training counts letter trigrams per language over labelled rows, as a Spark aggregation.
It uses about ``SAMPLE`` distinct texts per language, chosen by a hash of the text, or all
if there are fewer, each once however many copies there are. All their trigrams are kept;
that sample is what bounds the model, which is sent to the tasks as it is.

A text is cut at white space. A word longer than ``LONGEST``, as of scripts that write no
blanks, is walked in parts of that length, but its trigrams are those of the whole word. The scripts of a word's letters narrow the candidates to
the languages that use them; a word scores each candidate by its trigrams, within
``CLIP`` of the best. Viterbi's algorithm then labels the words: staying in a language is
free, switching costs ``SWITCH``. Where no stretch of words speaks for another language
by more than half that cost, the best single language is already the best path, which is
seen from running sums without walking the words.

The text's language is that of most letters; its score is their share times the
probability of that language against the others over the whole text.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and no
spans, and so is every text if there was nothing to learn from; ties go to the first
language in alphabetical order; letters of a script no language uses speak for none.
Repeated rows and extra columns make no difference. Rows whose label is null are not
learned from.
"""

from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 5_000
SWITCH = 12.0
CLIP = 6.0
FAR = 30.0
SCRIPT_SHARE = 0.01
REMEMBERED = 300_000
LONGEST = 48
LEAST_SPOKEN = 0.5
UNKNOWN = "und"
_PART = "\n"  # begins parts of long words; no word holds it

# First code point of each script's main ranges; None ends a range.
SCRIPT_STARTS = [
    (0x0041, "Latin"), (0x02B0, None), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, None), (0x0750, "Arabic"), (0x0780, None),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, None), (0x1780, "Khmer"),
    (0x1800, None), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, None), (0x3040, "Kana"), (0x3100, None),
    (0x3400, "Han"), (0xA000, None), (0xAC00, "Hangul"), (0xD7B0, None), (0xF900, "Han"), (0xFB00, None),
    (0x20000, "Han"), (0x32000, None),
]
_STARTS = [s for s, _ in SCRIPT_STARTS]


def script_of(letter: str) -> str | None:
    at = bisect_right(_STARTS, ord(letter)) - 1
    return SCRIPT_STARTS[at][1] if at >= 0 else None


def letters_of(word: str) -> str:
    """The word's letters in lower case, other characters as single blanks, blanks around; a part of a word as it is."""
    if word.startswith(_PART):
        return word[1:]
    low = word.lower()
    if low.isalpha():
        return f" {low} "
    if low[:-1].isalpha():
        return f" {low[:-1]} "
    return f" {' '.join(''.join(c if c.isalpha() else ' ' for c in low).split())} "


def n_letters(letters: str) -> int:
    """Letters in the middle of a trigram: those of a word, or of a part without its neighbours' overlap."""
    return len(letters) - 2 - letters.count(" ", 1, len(letters) - 1)


def grams_of(letters: str) -> list[str]:
    return [letters[i : i + 3] for i in range(len(letters) - 2)]


def pieces_of(text: str) -> list[str]:
    """Words between white space; longer ones than ``LONGEST`` as marked parts that begin ``LONGEST`` trigrams each."""
    words = text.split()
    if len(text) > LONGEST and any(len(w) > LONGEST for w in words):
        return [p for w in words for p in ([w] if len(w) <= LONGEST else _parts(letters_of(w)))]
    return words


def _parts(letters: str) -> list[str]:
    return [_PART + letters[i : i + LONGEST + 2] for i in range(0, max(1, len(letters) - 2), LONGEST)]


@dataclass
class Model:
    """What was learned: ``weights`` has a row per trigram and a last one for unseen ones."""

    languages: list[str]
    rows: dict[str, int]
    weights: np.ndarray
    scripts: dict[str, np.ndarray]

    def parts(self) -> tuple:
        return self.languages, self.rows, self.weights, self.scripts


def _grams(words: dict[str, Counter]) -> Counter:
    """Trigrams and letters of each script per language, from counts of distinct words."""
    grams: Counter = Counter()
    for lang, counts in words.items():
        folded: Counter = Counter()
        for word, n in counts.items():
            folded[letters_of(word)] += n
        del folded["  "]  # words without a letter
        for letters, n in folded.items():
            for gram in grams_of(letters):
                grams[lang, gram] += n
            if max(letters) < "\u02b0":
                grams[lang, "script Latin"] += n * n_letters(letters)
            else:
                for script in filter(None, map(script_of, letters[1:-1])):
                    grams[lang, "script " + script] += n
    return grams


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from rows with a text and a language."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("place", F.xxhash64("text"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang", "place").count().groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return Model([], {}, np.zeros((1, 0), np.float32), {})
    # About `sample` distinct texts of each language, whole, by a hash of the text; all of few.
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, sample / n))])
    drawn = rows.filter(F.pmod("place", F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    chosen = drawn.groupBy("lang", "place").agg(F.min("text").alias("text")).select("text", "lang")

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(pieces_of(text))
                if sum(map(len, words.values())) > REMEMBERED:
                    yield made(_grams(words))
                    words.clear()
        yield made(_grams(words))

    def made(grams):
        return pa.record_batch(
            [pa.array([k[0] for k in grams], pa.string()), pa.array([k[1] for k in grams], pa.string()), pa.array(list(grams.values()), pa.int64())],
            names=["lang", "gram", "n"],
        )

    sums = chosen.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = sums.collect()  # bounded by the sample
    languages = sorted(counts)
    column = {lang: i for i, lang in enumerate(languages)}
    grams = sorted({r.gram for r in kept if not r.gram.startswith("script ")})
    row = {g: i for i, g in enumerate(grams)}
    seen = np.zeros((len(grams) + 1, len(languages)))
    scripts: dict[str, np.ndarray] = {}
    for r in kept:
        if r.gram.startswith("script "):
            scripts.setdefault(r.gram[7:], np.zeros(len(languages)))[column[r.lang]] = r.n
        else:
            seen[row[r.gram], column[r.lang]] = r.n
    weights = np.log((seen + 0.5) / (seen.sum(0) + 0.5 * len(seen)))
    letters = sum(scripts.values(), np.zeros(len(languages)))
    uses = {s: n >= SCRIPT_SHARE * np.maximum(letters, 1) for s, n in scripts.items()}
    return Model(languages, row, weights.astype(np.float32), uses)


class Labeller:
    """Scores words and walks them; remembers the words it met, within bounds."""

    def __init__(self, model: Model, switch: float = SWITCH) -> None:
        self.model, self.switch = model, switch
        self.start()

    def start(self) -> None:
        # Row 0 is for words without a letter.
        self.known: dict[str, int] = {}
        self.rows: dict[str, int] = {"  ": 0}
        self.scores = np.zeros((1, len(self.model.languages)), dtype=np.float32)
        self.letters = np.zeros(1, dtype=np.int64)
        self.spoken = np.zeros(1, dtype=bool)

    def _candidates(self, letters: str) -> np.ndarray | None:
        """Languages that use the script of most letters."""
        scripts = Counter(s for s in map(script_of, letters) if s)
        main = min(scripts, key=lambda s: (-scripts[s], s)) if scripts else None
        return self.model.scripts.get(main)

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row for each word's letters: its trigrams' weights, narrowed to the candidates; and whether it has any."""
        rows, unseen = self.model.rows.get, len(self.model.rows)
        flat = [rows(w[i : i + 3], unseen) for w in words for i in range(len(w) - 2)]
        starts = np.cumsum([0, *[len(w) - 2 for w in words[:-1]]])
        totals = np.add.reduceat(self.model.weights[flat], starts, axis=0)
        latin = self.model.scripts.get("Latin")
        may = np.zeros(totals.shape, dtype=bool)
        for i, w in enumerate(words):
            own = latin if max(w) < "\u02b0" else self._candidates(w)
            if own is not None:
                may[i] = own
        best = np.where(may, totals, -np.inf).max(1, keepdims=True)
        best[~np.isfinite(best)] = 0
        scores = np.where(may, np.maximum(totals - best, -CLIP), -FAR)
        scores[~may.any(1)] = 0
        return scores.astype(np.float32), may.any(1)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.start()
        if not (new := [w for w in words if w not in self.known]) or not self.model.languages:
            return
        letters = [letters_of(w) for w in new]
        if unmet := list({x for x in letters if x not in self.rows}):
            self.rows.update(zip(unmet, range(len(self.rows), len(self.rows) + len(unmet))))
            scores, spoken = self._score(unmet)
            self.scores = np.concatenate([self.scores, scores])
            self.letters = np.concatenate([self.letters, [n_letters(x) for x in unmet]])
            self.spoken = np.concatenate([self.spoken, spoken])
        self.known.update(zip(new, map(self.rows.__getitem__, letters)))

    def path(self, scores: np.ndarray) -> np.ndarray | int:
        """Language of each word, or one number if all have the same."""
        best = int(scores.sum(0, dtype=np.float64).argmax())
        gain = np.cumsum(scores - scores[:, [best]], axis=0, dtype=np.float64)
        low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
        low = np.concatenate([np.zeros((1, gain.shape[1])), low[:-1]])
        if (gain - low).max() <= self.switch / 2:
            return best
        n = range(scores.shape[1])
        value, back = scores[0].tolist(), []
        for s in scores[1:].tolist():
            top = max(n, key=value.__getitem__)
            moved = value[top] - self.switch
            back.append([i if value[i] >= moved else top for i in n])
            value = [max(value[i], moved) + s[i] for i in n]
        at = max(n, key=value.__getitem__)
        out = [at]
        for step in reversed(back):
            at = step[at]
            out.append(at)
        return np.array(out[::-1])

    def spoken_share(self, words: list[str]) -> float:
        """Share of the letters in words whose main script a learned language uses."""
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words)) if self.model.languages else np.zeros(0, np.int64)
        letters = self.letters[at]
        return float(letters[self.spoken[at]].sum() / letters.sum()) if letters.any() else 0.0

    def label(self, text: str | None, words: list[str]) -> tuple[str, float, list[tuple[str, int, int]]]:
        """Language, score, and spans (language, first word, end) of a text."""
        languages = self.model.languages
        if not languages:
            return UNKNOWN, 0.0, []
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        letters = self.letters[at]
        if not letters.any():
            return UNKNOWN, 0.0, []
        scores = self.scores[at]
        path = self.path(scores)
        if isinstance(path, int):
            best, share, spans = path, 1.0, [(languages[path], 0, len(words))]
        else:
            each = np.bincount(path, weights=letters, minlength=len(languages))
            best = int(each.argmax())
            share = float(each[best] / letters.sum())
            cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(words)]
            spans = [(languages[path[a]], a, b) for a, b in zip(cuts, cuts[1:])]
        totals = scores.sum(0, dtype=np.float64)
        chance = 1.0 / np.exp(np.clip(totals - totals[best], -700, 700)).sum()
        return languages[best], min(1.0, share * max(chance, 1.0 / len(languages))), spans


def _labelled(texts: list, labeller: Labeller, slice_rows: int = 1000):
    """Each text's label, and its words."""
    for at in range(0, len(texts), slice_rows):
        some = texts[at : at + slice_rows]
        words = [pieces_of(t or "") for t in some]
        labeller.learn(set().union(*words))
        for t, w in zip(some, words):
            yield labeller.label(t, w), w


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())
    span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def label(batches):
        labeller = Labeller(Model(*sent.value), switch)
        for batch in batches:
            found = [f for f, _ in _labelled(batch.column(1).to_pylist(), labeller)]
            spans = [[{"lang": a, "start": b, "end": c} for a, b, c in f[2]] for f in found]
            yield pa.record_batch(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(label, schema)


def keep_languages(docs: DataFrame, model: Model, wanted: list[str] | None = None, text_col: str = "text", switch: float = SWITCH,
                   least_spoken: float = LEAST_SPOKEN, least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` in a wanted language; by default, in any learned one.

    A text must also have ``least_spoken`` of its letters in words of a script that a learned
    language uses, and a score of ``least_score``: a text in another script is in no learned language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())
    place = docs.columns.index(text_col)
    good = set(model.languages if wanted is None else wanted)

    def keep(batches):
        labeller = Labeller(Model(*sent.value), switch)
        for batch in batches:
            found = _labelled(batch.column(place).to_pylist(), labeller)
            stays = [f[0] in good and f[1] >= least_score and labeller.spoken_share(w) >= least_spoken for f, w in found]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
