"""Small documents with the cases that tables may hold, and brute-force versions of the operators."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, component_id long"


def documents(seed=1, n=60):
    """Nulls, empty and very long texts, repeated rows, copies, near copies, repeated lines, columns with clashing names."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(400)}" + rng.choice(["", "é", "ñ", ",", "."]) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = text(90)
    line = "all rights reserved by the owners of this text"
    out = []
    for i in range(n):
        lines = [text(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 5))]
        if i % 5 == 0:
            lines.insert(1, line)
        if i % 7 == 0:
            lines.append(shared)
        out.append("\n".join(lines))
    for i in range(6):
        out.append(out[i])
        near = out[i + 10].split(" ")
        near[len(near) // 2] = "changed"
        out.append(" ".join(near))
    out += [None, "", " ", "\n\n", "one", "two words", "Ünïcode 🙂 text\twith\x0btabs", text(20000), "ab" * 700, "A" * 1500]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1"]), len(t or ""), 0.5, "x", 1) for i, t in enumerate(out)]
    return rows + [rows[3], (None, out[4], "en", "s0", 3, 0.5, "x", 1), (None, None, None, None, None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, k=3):
    w = white_words(ascii_lower(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, percent=85, k=3):
    """doc_id -> smallest doc_id reachable over links."""
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets[r[0]] = shingle_set(r[1], k)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def removed_lines(rows, least):
    """Per row: lines, removed lines, runs, what is left. Rows are in order of doc_id."""
    seen, out = set(), []
    for r in sorted(set(rows), key=lambda r: r[0]):
        lines = r[1].split("\n") if r[1] is not None else []
        full = [(i, line) for i, line in enumerate(lines) if white_words(line)]
        gone = set()
        for s in range(len(full)):
            n = 0
            for e in range(s, len(full)):
                n += len(white_words(full[e][1]))
                if n >= least:
                    key = tuple(line for _, line in full[s : e + 1])
                    if key in seen:
                        gone |= set(range(full[s][0], full[e][0] + 1))
                    seen.add(key)
                    break
        runs = sum(1 for i in gone if i - 1 not in gone)
        out.append((r[0], len(lines), len(gone), runs, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def repeated_bytes(texts, length):
    """Per text: bytes, removed, spans, SHA-256 of what is left."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def phrase_hits(text, items, window=10):
    """Words, hit words and items of a text."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    words, hit, found = terms(text), set(), set()
    for item, body in items:
        w = terms(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            g = w[i : i + window]
            for p in range(len(words) - len(g) + 1):
                if words[p : p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def near_items(text, items, window=10, reach=20):
    """Items of which a window has all its words within `reach` words of its longest one."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    words, found = terms(text), set()
    for item, body in items:
        w = terms(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            g = w[i : i + window]
            centre = max(g, key=lambda x: len(x.encode()))
            if any(x == centre and set(g) <= set(words[max(0, p - reach) : p + reach + 1]) for p, x in enumerate(words)):
                found.add(item)
    return found


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return by_start(found, ("email", "ip", "card", "phone"))


def secrets(text):
    found = [("assign", *m.span()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return by_start(found, ("assign", "access", "hex"))


def by_start(found, kinds):
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(found, key=lambda s: (s[1], kinds.index(s[0]))))


# Lines written by hand, none from the templates that the trees learn from: the value, its kind and whether it is personal.
HELD_OUT = [
    ("you can reach maria at gmail dot com", "maria at gmail dot com", "email", 1), ("Kontakt: peter.mueller [at] web.de, danke", "peter.mueller [at] web.de", "email", 1), ("it is john (at) company (dot) org I think", "john (at) company (dot) org", "email", 1),
    ("sales{at}shop.net answers", "sales{at}shop.net", "email", 1), ("ask bob_k at mail dot org please", "bob_k at mail dot org", "email", 1), ("support [at] some-host [dot] io", "support [at] some-host [dot] io", "email", 1),
    ("ping ip 10 . 0 . 0 . 1 first", "10 . 0 . 0 . 1", "ip", 1), ("the server at 192. 168. 1. 254 is down", "192. 168. 1. 254", "ip", 1), ("login on 172 .16 .5 .20 now", "172 .16 .5 .20", "ip", 1),
    ("she paid, card 4539/1488/0343/6467, yesterday", "4539/1488/0343/6467", "card", 1), ("my visa 4111_1111_1111_1111 was stolen", "4111_1111_1111_1111", "card", 1), ("credit 4012.8888.8888.1881 exp 04/27", "4012.8888.8888.1881", "card", 1),
    ("call me on (415) 555-2671 after six", "(415) 555-2671", "phone", 1), ("Tel. 030 901 8204 (office)", "030 901 8204", "phone", 1), ("fax: 0171/555 3211", "0171/555 3211", "phone", 1), ("mobile (212) 736-5000, evenings", "(212) 736-5000", "phone", 1),
    ("we met at noon. Then we left", "met at noon. Then", "email", 0), ("she works at home. Denes too", "works at home. Denes", "email", 0), ("just look at that. Es war gut", "look at that. Es", "email", 0), ("they stayed at sea. a storm came", "stayed at sea. a", "email", 0),
    ("see section 3. 2. 10. 4 of the act", "3. 2. 10. 4", "ip", 0), ("version 2. 3. 118. 40 was released", "2. 3. 118. 40", "ip", 0),
    ("reports 2019/2020/2021/2022 are late", "2019/2020/2021/2022", "card", 0), ("order 0012-3456-7890-1235 was sent", "0012-3456-7890-1235", "card", 0), ("serial 7310.1111.2222.3334 here", "7310.1111.2222.3334", "card", 0),
    ("due on 01/02/2019 at the latest", "01/02/2019", "phone", 0), ("born 07-11-1998 in Rome", "07-11-1998", "phone", 0), ("part 555.123.456 is out", "555.123.456", "phone", 0), ("ref 0123/45-67 was closed", "0123/45-67", "phone", 0),
]
