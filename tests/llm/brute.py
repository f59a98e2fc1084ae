"""Brute-force versions of the operators: plain Python over all rows, nothing shared with them."""

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter

import public_tokenizers as P
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n)


def licenses(text):
    words = ALNUM.findall(lower_ascii(text or ""))
    places, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def token_files(rows):
    """rows: (doc_id, text); ids by the tokenizers library on whole texts."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    at, out = 0, []
    for doc, text in sorted(rows):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def fingerprint(text):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """rows: (doc_id, text); (doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = [(d, fingerprint(t)) for d, t in rows]
    head = list(range(len(prints)))

    def find(x):
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                head[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{fp:016x}", least[find(i)]) for i, (d, fp) in enumerate(prints)]


def warc(rows):
    """rows: (page_id, html)."""
    first = {}
    for page, html in rows:
        first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, html in rows:
        data, original = (html or "").encode(), first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if page == original else "revisit", None if page == original else original))
    return out


BASE = (
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


def secrets(text):
    spans, counts = [], []
    for no, (kind, pattern, good) in enumerate(BASE):
        found = [m.span() for m in re.finditer(pattern, text or "") if good(m)]
        counts.append(len(found))
        spans += [(a, no, f"{kind}:{a}:{b}") for a, b in found]
    return (*counts, sha(",".join(s for _, _, s in sorted(spans))), [s for _, _, s in sorted(spans)])


def decontamination(docs, items):
    """docs: (doc_id, text); items: (item_id, text)."""
    windows = {}
    for item, text in items:
        words = ALNUM.findall(lower_ascii(text or ""))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i : i + 13]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = ALNUM.findall(lower_ascii(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if items_here := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= items_here
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def word_bpe(text):
    import tiktoken

    global _ENCODING
    if "_ENCODING" not in globals():
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
        _ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = _ENCODING.encode_ordinary(text or "")
    return (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(text or ""))


def alignment(rows):
    """rows: (doc_id, text); both libraries on whole texts, groups by walking the bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    done, counts = [], Counter()
    for doc, text in rows:
        a, b = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids, b_lib.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("\u2581", " ").encode() for p in map(b_lib.id_to_piece, b)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end, b_end = {}, {}
        for ends, tokens in ((a_end, a_bytes), (b_end, b_bytes)):
            at = 0
            for k, t in enumerate(tokens):
                at += len(t)
                ends[at] = k
        common = sorted(a_end.keys() & b_end.keys())
        links = [(a[a_end[e]], b[b_end[e]]) for e in common]
        counts.update(links)
        groups, i, j = [], 0, 0
        for e in common:
            groups.append(",".join(map(str, a[i : a_end[e] + 1])) + "|" + ",".join(map(str, b[j : b_end[e] + 1])))
            i, j = a_end[e] + 1, b_end[e] + 1
        done.append((doc, len(a), len(b), links, sha(";".join(groups)) if groups else ""))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    return [(d, n_a, n_b, len(links), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), h) for d, n_a, n_b, links, h in done]


BLANK = " \t\n\x0b\f\r"


def damaged(rows):
    """rows: (conv_id, turn, role, text); the rows of each conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            here += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) for c, r in out.items()}


def repaired(rows):
    """rows: (turn, role, text) in order. Every way of editing is followed by cost, then by letters."""
    import heapq

    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(BLANK)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    legal, whole = re.compile("(s?(ua)*u?)"), re.compile("(s?(ua)+)?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, kept = heapq.heappop(heap)
        if at == len(rows) and whole.fullmatch(roles):
            break
        if (at, roles[-1:]) in done:
            continue
        done.add((at, roles[-1:]))
        ways = [("I", 5, at, x, (r, "")) for r, x in (("user", "u"), ("assistant", "a"))]
        if at < len(rows):
            _, role, text = rows[at]
            more = 5 * (faults[at] == "truncated")
            ways.append(("D", 2, at + 1, "", None))
            if faults[at] not in ("blank", "duplicate"):
                ways.append(("K", more, at + 1, role[:1] or "?", (role, text)))
                ways += [("R", 1 + more, at + 1, x, (r, text)) for r, x in (("user", "u"), ("assistant", "a"))]
        for letter, c, to, x, row in ways:
            if legal.fullmatch(roles + x):
                heapq.heappush(heap, (cost + c, audit + letter, to, roles + x, kept + ((row,) if row else ())))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit), kept


def conversations(rows):
    out = []
    for conv, turns in damaged(rows).items():
        found, kept = repaired(turns)
        out.append((conv, *found, sha("\n".join(f"{r}:{t}" for r, t in kept))))
    return out


def mix64(x):
    x = (x + 0x9E3779B97F4A7C15) % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def random64(stream, number):
    return mix64(mix64(20_240_101 + stream) ^ number)


def edit_print(text):
    """128 hex digits: two walks of the text, character by character, 64 steps of each read."""
    signs = [mix64(ord(c)) | 1 for c in text] + [0] * 4
    steps, out = 2 * len(text), []
    for slot in range(128):
        if not text:
            return "0" * 128
        step = at = k = 0
        while True:  # as a reservoir of one place takes a later step instead
            u = (random64(1000 + slot, k) >> 11) / 2**53
            at, k = max(at + 1, int((at + 1) / max(u, 1e-12))), k + 1
            if at >= steps:
                break
            step = at
        here = 0
        for j in range(step):
            here += signs[here] * (random64(slot // 64, j) | 1) % 2**64 >> 63
        h = random64(5000, step * 128 + slot)
        for g in range(4):
            h = mix64(h ^ signs[here + g])
        out.append(f"{h >> 60:x}")
    return "".join(out)


def print_likeness(a, b):
    return max(sum(x == y for x, y in zip(a, b)) / 128 - 1 / 16, 0) / (15 / 16)


def edit_prints(rows):
    """rows: (doc_id, text) without equal ids; the columns of the query."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        prints = [edit_print(t) for t in (text, new, after)]
        out.append((doc, len(text), sha(new), prints[0], prints[1], print_likeness(prints[0], prints[1]), print_likeness(prints[0], prints[2])))
    return out


def near_by_prints(rows, least, places):
    """rows: (doc_id, text, fingerprint); class and number of links by comparing all pairs that share a band, ``places`` being the bands."""
    prints = {t: f for _, t, f in rows}
    texts, linked = list(prints), {t: set() for t in prints}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = prints[a], prints[b]
            if any(all(x[p] == y[p] for p in band) for band in places) and print_likeness(x, y) >= least:
                linked[a].add(b)
                linked[b].add(a)
    ids, out = {}, []
    for d, t, _ in rows:
        ids.setdefault(t, []).append(d)
    for d, t, _ in rows:
        reached, open_ = {t}, [t]
        while open_:
            for u in linked[open_.pop()] - reached:
                reached.add(u)
                open_.append(u)
        out.append((d, min((i for u in reached for i in ids[u] if i is not None), default=None), len(linked[t])))
    return out


SCRIPTS = [(0x41, 0x24F, "Latin"), (0x370, 0x3FF, "Greek"), (0x400, 0x52F, "Cyrillic"), (0x3400, 0x9FFF, "Han"), (0x3040, 0x30FF, "Kana")]


def word_letters(word):
    return " " + " ".join("".join(c if c.isalpha() else " " for c in word.lower()).split()) + " "


def pieces(text, longest=48):
    """The letters of each word, those of long words in parts that begin ``longest`` trigrams each."""
    out = []
    for word in text.split():
        letters = word_letters(word)
        out += [letters] if len(word) <= longest else [letters[i : i + longest + 2] for i in range(0, max(1, len(letters) - 2), longest)]
    return out


def letter_count(letters):
    return sum(c != " " for c in letters[1:-1])


def script(c):
    return next((name for a, b, name in SCRIPTS if a <= ord(c) <= b), None)


def language_model(rows):
    """rows: (text, lang) to learn from, each distinct text once: weights of trigrams, and scripts, per language."""
    import math

    languages, grams, scripts = sorted({lang for _, lang in rows}), Counter(), Counter()
    for text, lang in sorted(set(rows)):
        for letters in pieces(text):
            if letters != "  ":
                grams.update((lang, letters[i : i + 3]) for i in range(len(letters) - 2))
                scripts.update((lang, s) for s in map(script, letters[1:-1]) if s)
    names = {g for _, g in grams}
    total = {lang: sum(n for (x, _), n in grams.items() if x == lang) for lang in languages}
    weight = {(lang, g): math.log((grams[lang, g] + 0.5) / (total[lang] + 0.5 * (len(names) + 1))) for lang in languages for g in [*names, None]}
    letters = {lang: sum(n for (x, _), n in scripts.items() if x == lang) for lang in languages}
    uses = {s: [scripts[lang, s] >= 0.01 * max(letters[lang], 1) for lang in languages] for _, s in scripts}
    return languages, names, weight, uses


def language(text, model, switch=12.0):
    """Language and score by trying, word after word, every language for it and for the word before."""
    import math

    languages, names, weight, uses = model
    words = pieces(text or "")
    if not any(map(letter_count, words)):
        return "und", 0.0
    scores = []
    for w in words:
        found = Counter(s for s in map(script, w) if s)
        may = uses.get(min(found, key=lambda s: (-found[s], s))) if found else None
        if w == "  " or not may or not any(may):
            scores.append([0.0] * len(languages))
            continue
        totals = [sum(weight[lang, w[i : i + 3] if w[i : i + 3] in names else None] for i in range(len(w) - 2)) for lang in languages]
        best = max(t for t, m in zip(totals, may) if m)
        scores.append([max(t - best, -6.0) if m else -30.0 for t, m in zip(totals, may)])
    n = range(len(languages))
    value, back = list(scores[0]), []
    for s in scores[1:]:
        came = [max(n, key=lambda j: (value[j] - switch * (j != i), j == i, -j)) for i in n]
        value = [value[j] - switch * (j != i) + s[i] for i, j in enumerate(came)]
        back.append(came)
    at = max(n, key=lambda i: (value[i], -i))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    path.reverse()
    each = [sum(letter_count(w) for w, p in zip(words, path) if p == i) for i in n]
    best = max(n, key=lambda i: (each[i], -i))
    sums = [sum(s[i] for s in scores) for i in n]
    chance = 1.0 / sum(math.exp(min(max(t - sums[best], -700), 700)) for t in sums)
    return languages[best], min(1.0, each[best] / sum(each) * max(chance, 1.0 / len(languages)))
