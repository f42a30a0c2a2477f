"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from html.parser import HTMLParser

from tallyhouse.llm import html_text as page_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def shingles(text, width):
    found = words(lower(text))
    width = min(width, len(found))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if found else set()


def near_duplicates(rows, width):
    """{doc_id: (n_shingles, component)} by comparing every pair that shares a shingle."""
    sets = {doc_id: shingles(text, width) for doc_id, text in rows}
    holders = defaultdict(list)
    for doc_id, one in sets.items():
        for shingle in one:
            holders[shingle].append(doc_id)
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    common = defaultdict(int)
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    for (a, b), count in common.items():
        if 100 * count >= 80 * (len(sets[a]) + len(sets[b]) - count):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {doc_id: (len(one), root(doc_id)) for doc_id, one in sets.items()}


def quality_base(text):
    found = words(text)
    seen, duplicated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            duplicated += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(found) - 4):
        windows[tuple(found[i : i + 5])].append(i)
    repeated = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(5)}
    n, r = len(found), len(repeated)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, found)), symbols, duplicated, r, n < 10 or 100 * r > 20 * n


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def personal_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def secret_base(text):
    text = text or ""
    assign = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def shared_lines(rows, min_docs=10, keep_first=False):
    """[(doc_id, n_lines, n_dropped, kept text)] for rows (doc_id, text); equal rows are one document."""
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(blanks))].add((doc_id, text))
    shared = {key for key, found in holders.items() if key and len(found) >= min_docs}
    out, first = [], {}
    if keep_first:  # ids are in order in the tests that use this
        for doc_id, text in sorted(set(rows)):
            for place, line in enumerate((text or "").split("\n")):
                first.setdefault(lower(line.strip(blanks)), (doc_id, text, place))
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [lower(line.strip(blanks)) for line in lines]
        stays = [key not in shared or first.get(key) == (doc_id, text, i) for i, key in enumerate(keys)]
        out.append((doc_id, len(lines), stays.count(False), "\n".join(x for x, stay in zip(lines, stays) if stay)))
    return out


def spelling_variants(rows, min_length=5, min_count=3):
    """{word: (form, root, n, n_near, form_n)} by trying every edit of every word."""
    counts = defaultdict(int)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {word: n for word, n in counts.items() if len(word) >= min_length and n >= min_count}
    letters, near, form = sorted({c for word in words for c in word}), {}, {}
    for word in words:
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        near[word] = [other for other in edits if other in words and other != word]
        best = min(near[word], key=lambda other: (-words[other], other), default=None)
        if best is not None and words[best] >= 2 * words[word]:
            form[word] = best
    out = {}
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out[word] = (form.get(word), root, n, len(near[word]), words.get(form.get(word)))
    return out


def hard_negatives(rows, every=100, positives=5, negatives=5, low=80):
    """Sorted result rows for rows (vec_id, label, vector of integers), ids not repeated."""
    out = []
    for anchor, label, vector in rows:
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, other)), i, kind) for i, kind, other in rows if i != anchor]
        scored.sort()
        for minus, positive in [(s, i) for s, i, kind in scored if kind == label][:positives]:
            fits = [(s, i) for s, i, kind in scored if kind != label and low * -minus <= 100 * -s <= 100 * -minus]
            out += [(anchor, positive, rank, i, -minus, -s) for rank, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


class _Walk(HTMLParser):
    """(text, share of link characters, names of the open elements, marked) of the blocks of plain pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.pieces, self.found, self.skipped, self.link = [], [], [], "", False

    def cut(self):
        text = " ".join("".join(p for p, _ in self.pieces).split())
        if text:
            linked = sum(len(p) for p, link in self.pieces if link and p.strip())
            self.found.append((text, linked / len(text), [tag for tag, _ in self.open], any(ad for _, ad in self.open)))
        self.pieces = []

    def handle_starttag(self, tag, attrs):
        if self.skipped or tag in page_rules.RAW:
            self.skipped = self.skipped or tag
        elif tag == "a":
            self.link = True
        elif tag == "br":
            self.pieces.append(("\n", False))
        elif tag in page_rules.BLOCKS:
            self.cut()
            if tag in ("p", "li") and self.open and self.open[-1][0] == tag:
                self.open.pop()
            if tag not in page_rules.VOID:
                self.open.append((tag, dict(attrs).get("class") == "ad"))

    def handle_endtag(self, tag):
        if self.skipped:
            self.skipped = "" if tag == self.skipped else self.skipped
        elif tag == "a":
            self.link = False
        elif tag in page_rules.BLOCKS:
            self.cut()
            if tag in [name for name, _ in self.open]:
                while self.open.pop()[0] != tag:
                    pass

    def handle_data(self, data):
        if not self.skipped:
            self.pieces.append((data, self.link))


def main_text(html):
    """Block rules on the open elements of a page whose only marked class is ``ad``, every neighbour looked at."""
    walk = _Walk()
    walk.feed(html)
    walk.close()
    walk.cut()
    rows = []
    for text, linked, tags, ad in walk.found:
        stops = [re.sub(r"^\W+|\W+$", "", word) in page_rules.STOP_WORDS for word in text.lower().split()]
        share = sum(stops) / len(stops)
        if linked > 0.4 or "\xa9" in text and len(text) < 200:
            rule = -1
        elif len(text) < 70:
            rule = 0
        elif share >= 0.2 or share >= 0.1 and len(text) >= 200:
            rule = 1
        else:
            rule = -1 if share < 0.05 and len(text) < 200 else 0
        hint = -1 if ad or {"nav", "footer"} & set(tags) else 1 if "article" in tags else 0
        label = rule if rule != -hint else -1 if hint < 0 else 0
        rows.append((text, label, hint, tags[-1:] in (["h1"], ["h2"], ["h3"])))
    kept = []
    for i, (text, label, hint, heading) in enumerate(rows):
        seen = [(abs(j - i), j > i, other) for j, (_, other, place, _) in enumerate(rows)
                if other and (place == hint or not hint)]
        if heading and not label and any(after for _, after, _ in seen):
            seen = [one for one in seen if one[1]]
        least = min((distance for distance, _, _ in seen), default=None)
        near = [other for distance, _, other in seen if distance == least]
        if label == 1 or not label and (all(other == 1 for other in near) if near else hint >= 0):
            kept.append(text)
    return "\n".join(kept)
