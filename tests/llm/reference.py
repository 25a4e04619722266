"""Brute-force versions that several tests use."""

import math
import re
from collections import Counter, defaultdict

from tianguis.llm import quality_rules as rules

LOWER = {c: c + 32 for c in range(65, 91)}


def surface(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def histograms(text, lang):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if lang not in rules.COMMON_WORDS:
        return None
    classes = [sum(len(m) for m in re.findall(c, text)) for c in rules.CHARACTER_CLASSES]
    commons = [words.count(w) for w in rules.COMMON_WORDS[lang]]
    return [*classes, len(text) - sum(classes)], [*commons, len(words) - sum(commons)]


def distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return math.sqrt(max(sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2, 0))


def quality_kept(rows, min_reference=rules.MIN_REFERENCE_WORDS):
    """[(doc_id, text, lang)] to the list of verdicts."""
    totals, found = {}, []
    for _, text, lang in rows:
        base, both = surface(text), histograms(text, lang)
        found.append((base, both, lang))
        if both and not base[5]:
            total = totals.setdefault(lang, [[0] * len(both[0]), [0] * len(both[1]), 0])
            for k in (0, 1):
                total[k] = [a + b for a, b in zip(total[k], both[k])]
            total[2] += base[0]
    out = []
    for base, both, lang in found:
        kept = not base[5]
        if kept and both and base[0] >= rules.MIN_WORDS_FOR_DIVERGENCE and totals[lang][2] >= min_reference:
            limits = (rules.MAX_CHARACTER_DISTANCE, rules.MAX_WORD_DISTANCE)
            kept = all((distance(both[k], totals[lang][k]) or 0) <= limits[k] for k in (0, 1))
        out.append(kept)
    return out


def exact_kept(rows):
    """The rows that stay, of [(doc_id, text, ..)] with different ids."""
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(row)
    return [max(g, key=lambda r: r[0]) for g in groups.values()]
