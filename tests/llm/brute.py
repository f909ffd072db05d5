"""Plain answers to hold the operators against, and inputs with every odd case."""

import hashlib
import re

ODD = [
    (None, "A line that has no number at all, but words enough to count.", None),
    (1, None, "en"),
    (2, "", "en"),
    (3, " \n\t\r\n ", None),
    (4, "Word", "en"),
    (5, "A line that has no number at all, but words enough to count.\nAnother one that follows it here.", "en"),
    (5, "A line that has no number at all, but words enough to count.\nAnother one that follows it here.", "en"),
    (6, "A line that has no number at all, but words enough to count.\nAnother one that follows it here.", "de"),
    (7, "Ünïcödé wörds → and ＡＢＣ, \u0001\u0002\u0003 control \U0001f600 signs end here today.", "fr"),
    (8, "very long " * 20_000, "en"),
]
SCHEMA = "doc_id long, text string, lang string"
CLASHING = "doc_id long, text string, lang string, score double, n long, id string, removed int, c0 string, found string"


def odd_docs(spark, clashing=False):
    if not clashing:
        return spark.createDataFrame(ODD, SCHEMA)
    return spark.createDataFrame([(*row, 0.5, None, "x", 3, "y", None) for row in ODD], CLASHING)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def repeats(docs, window):
    """Bytes kept of each document: removed are all under a window that starts earlier as well."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            if raw[p : p + window] in seen:
                gone[p : p + window] = b"\1" * window
            else:
                seen.add(raw[p : p + window])
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[doc_id] = (sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


def shingles(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(docs, size=4, percent=80):
    sets = {i: shingles(t, size) for i, t in docs}
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    rest = max(len(a), len(b)) - k - 1
    return rest == 0 or a[-rest:] == b[-rest:]


def removed_lines(docs, least=20):
    lines = []
    for doc_id, text in sorted(docs):
        for nr, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r").lower()
            if len(line) >= least:
                lines.append(((doc_id, nr), line))
    out = {doc_id: [] for doc_id, _ in docs}
    for k, ((doc_id, nr), line) in enumerate(lines):
        if any(other == line or one_edit(other, line) for _, other in lines[:k]):
            out[doc_id].append(nr)
    return out


def bench_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def hits(text, items, width=10):
    words, covered, found = bench_words(text), set(), set()
    for item, body in items:
        own = bench_words(body)
        for i in range(max(1, len(own) - width + 1) if own else 0):
            window = own[i : i + width]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    found.add(item)
                    covered.update(range(p, p + len(window)))
    return len(words), len(covered), sorted(found)


def secrets(text):
    text, out = text or "", []
    pattern = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(a, b, kind) for a, _, kind, b in sorted(out)]


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    mail = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    out += [(m.start(), 0, "email", m.end()) for m in re.finditer(mail, text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(a, b, kind) for a, _, kind, b in sorted(out)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
