"""Licence scans: identifier tags and notice phrases, and licence expressions.

One Aho-Corasick automaton, built per task from the phrase table, runs over the words of
a text (lower-cased, separated by single blanks), so a phrase is found whatever
punctuation or line breaks stand between its words, and the scan is linear in the text.
A second one finds identifier tags in the text itself. What follows a tag, to the next tag
or the end of its line, is a licence expression, so every character is read once: a
shunting-yard parser turns ``AND``, ``OR``, ``WITH`` and parentheses into postfix form
(``WITH`` binds tightest, then ``AND``), which is evaluated to the licences named and to
whether the expression can be met by permissive licences alone. Identifiers are compared
whole; a version, ``-only``, ``-or-later`` and ``+`` may follow a name.

``score`` is the strength of the evidence: 1 for a tag with a valid expression, 0.9 for
a notice phrase, 0.6 for a tag whose expression is not valid, 0 for nothing.

Defined cases: null and empty texts have no words and no labels; overlapping places all
count; an expression that cannot be parsed gives the licences of its longest beginning that
can, and counts as invalid, so prose behind a tag gives no label; repeated rows and extra columns make no difference; an empty table gives an
empty result.
"""

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import alnum_words

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases and their labels.
MORE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "cc0 1 0": "cc0",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
# Names of lower-cased identifiers, with the version where it matters, and their labels.
IDENTIFIERS = {
    "mit": "mit", "apache-2": "apache-2", "gpl-2": "gpl-2", "gpl-3": "gpl-3", "lgpl": "lgpl", "agpl": "agpl",
    "mpl": "mpl", "epl": "epl", "bsl": "bsl", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause",
    "isc": "isc", "unlicense": "unlicense", "cc0": "cc0", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa",
    "cc-by-nc-sa": "cc-by-nc", "cc-by-nc-nd": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "zlib": "zlib",
}
PERMISSIVE = {"mit", "apache-2", "bsl", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "unlicense", "cc0", "cc-by", "zlib"}

_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
_IDENTIFIER = re.compile(r"(.+?)(?:-v?([0-9]+)(?:\.[0-9]+)*)?(?:-only|-or-later|\+)?")
_BINDS = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: postfix order of an expression; ValueError if it is not one."""
    out: list[str] = []
    held: list[str] = []
    operand = False
    if "".join(_TOKEN.sub(" ", expression).split()):
        raise ValueError("characters of no expression")
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if low in _BINDS:
            if not operand:
                raise ValueError("an operator without a left side")
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[low]:
                out.append(held.pop())
            held.append(low)
            operand = False
        elif token == "(":
            if operand:
                raise ValueError("a parenthesis after a licence")
            held.append(token)
        elif token == ")":
            if not operand:
                raise ValueError("an empty parenthesis")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("an unopened parenthesis")
            held.pop()
        else:
            if operand:
                raise ValueError("two licences without an operator")
            out.append(low)
            operand = True
    if not operand or "(" in held:
        raise ValueError("an unfinished expression")
    return out + held[::-1]


def label_of(identifier: str) -> str | None:
    """The label of an identifier: of its name and first version number, or of its name alone."""
    name, version = _IDENTIFIER.fullmatch(identifier.rstrip(".:") or identifier).groups()
    return IDENTIFIERS.get(f"{name}-{version}") or IDENTIFIERS.get(name)


def longest_valid(expression: str) -> str:
    """The longest beginning that is an expression; empty if none is."""
    end = after = depth = 0
    operand = False
    for token in _TOKEN.finditer(expression):
        low = token[0].lower()
        strange = expression[after : token.start()].strip()
        if strange or operand == (low == "(" or low not in _BINDS and low != ")"):
            break
        after = token.end()
        depth += (low == "(") - (low == ")")
        operand = low not in _BINDS and low != "("
        if depth < 0:
            break
        if operand and not depth:
            end = after
    return expression[:end]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """Labels named, and whether permissive licences alone can meet the expression."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token not in _BINDS:
            label = label_of(token)
            stack.append(({label} - {None}, label in PERMISSIVE))
            continue
        (right, right_ok), (left, left_ok) = stack.pop(), stack.pop()
        if token == "with":  # an exception adds permissions to the licence on its left
            stack.append((left, left_ok))
        else:
            stack.append((left | right, left_ok or right_ok if token == "or" else left_ok and right_ok))
    return stack[0]


class Scanner:
    """Automata and parser of one task."""

    def __init__(self) -> None:
        self.phrases = ahocorasick.Automaton()
        for base, table in ((False, MORE_PHRASES), (True, BASE_PHRASES)):
            for phrase, label in table.items():
                self.phrases.add_word(f" {phrase} ", (label, base, len(phrase)))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def scan(self, text: str | None) -> dict:
        words = alnum_words(text)
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")  # a character per byte; the phrases are ASCII
        base, more, n_base = set(), set(), 0
        first = last = None
        counted, blanks = 0, 0
        for end, (label, is_base, size) in self.phrases.iter(line):
            (base if is_base else more).add(label)
            if is_base:
                start = end - size - 1  # the blank before the phrase
                if start >= counted:
                    blanks, counted = blanks + line.count(" ", counted, start), start
                    place = blanks
                else:  # a longer phrase that began earlier ends later
                    place = blanks - line.count(" ", start, counted)
                n_base += 1
                first = place if first is None else min(first, place)
                last = place if last is None else max(last, place)
        expressions, score, permissive = [], 0.9 if base or more else 0.0, None
        low = (text or "").translate(_LOWER)
        tags = [(end + 1 - len(tag), end + 1) for end, tag in self.tags.iter(low)]
        for (_, begin), (stop, _) in zip(tags, [*tags[1:], (len(low), 0)]):
            line = low.find("\n", begin, stop)
            rest = low[begin : stop if line < 0 else line].strip().rstrip("*/->").strip()
            try:
                named, ok = evaluate(to_postfix(rest))
                permissive = ok if permissive is None else permissive and ok
                score = 1.0
            except ValueError:
                valid = longest_valid(rest)
                named = evaluate(to_postfix(valid))[0] if valid else set()
                score = max(score, 0.6)
            more |= named
            expressions.append(rest)
        return {
            "n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last, "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | more)), "score": score, "permissive": permissive, "expressions": expressions,
        }


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("permissive", pa.bool_()), ("expressions", pa.list_(pa.string())),
])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the labels, places and expressions found in its text."""

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            found = [{"doc_id": i, **scanner.scan(t)} for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(found, schema=FOUND)

    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, permissive boolean, expressions array<string>")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)
