"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}


def versions(rows):
    """{id: (n_chars, sha256 of the edited text, likeness to it, likeness to the next)}"""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (-r[0], r[1]))

    def pieces(text):
        count = Counter()
        for line in text.split("\n"):
            words = line.split()
            count.update(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))
        return count

    def like(a, b):
        a, b = pieces(a), pieces(b)
        size = sum(a.values()) + sum(b.values())
        return 1.0 - sum(((a - b) + (b - a)).values()) / size if size else 1.0

    out = {}
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        digest = hashlib.sha256(new.encode()).hexdigest()
        out[key] = (len(text), digest, like(text, new), like(text, following))
    return out


def targets(sizes):
    """Target of each source of ``sizes``, by resharing until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        share = (total - sum(capped.values())) / max(sum(weight[s] for s in rest), 1)
        above = [s for s in rest if share * weight[s] > 2 * sizes[s]]
        if not above:
            return capped | {s: share * weight[s] for s in rest}
        capped |= {s: 2 * sizes[s] for s in above}


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def simhash(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """{id: smallest id reachable over links of three or fewer bits} from {id: fingerprint}"""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def licenses(text):
    """(n_words, starts of phrases, labels)"""
    words = LICENSE_WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for label, phrase in PHRASES.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                starts.append(i)
                labels.add(label)
    return len(words), starts, labels


def url_parts(url):
    rest = (url or "").partition("://")[2]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.DOTALL).groups()
    return host.translate(LOWER), path


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def shingle_groups(rows, size=4, percent=80):
    """{id: (size of its set of shingles, smallest id reachable over links of near sets)}"""
    sets = {}
    for key, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        if len(words) >= size:
            sets[key] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        else:
            sets[key] = {tuple(words)} if words else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(v), find(k)) for k, v in sets.items()}


def ngrams(rows, longest=5):
    """({(lang, phrase): count}, {lang: number of words}) of (text, lang) rows"""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, " ".join(words[i : i + m])] += 1
    return counts, totals


def collocations(rows, min_count=100, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) in the order of lang and rank"""
    counts, totals = ngrams(rows)
    found = {}
    for (lang, phrase), a in counts.items():
        words = phrase.split(" ")
        if a >= min_count and len(words) > 1:
            cuts = []
            for k in range(1, len(words)):
                left = counts[lang, " ".join(words[:k])]
                right = counts[lang, " ".join(words[k:])]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            found[lang, phrase] = (a, *min(cuts)[2:], totals[lang], min(cuts)[0])
    covered = set()
    for (lang, phrase), row in found.items():
        words = phrase.split(" ")
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = lang, " ".join(words[i : i + m])
                if row[0] >= found[inner][0]:
                    covered.add(inner)
    out = []
    for lang in sorted(totals):
        own = [(p, *row) for (name, p), row in found.items() if name == lang]
        own = [row for row in own if (lang, row[0]) not in covered]
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *row) for i, row in enumerate(own[:top], 1)]
    return out


def fill_middle(key, text, fim_percent=50, spm_percent=80):
    """(n, form, prefix_chars, middle_chars, digest of the output, digest of the text)"""
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    own = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, own, own
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:low], tokens[low:high], tokens[high:]))
    if h4 % 100 < spm_percent:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), hashlib.sha256(out.encode()).hexdigest(), own
