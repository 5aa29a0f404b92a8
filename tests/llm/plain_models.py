"""Brute-force versions of the operators, row by row in plain Python."""

import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_ids(texts, end_id=2):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id], "<u4") for t in texts]


def check_pieces(rows, ids_by_doc, window=4096):
    """Every id lies in exactly one piece and sequences are gapless; returns padding over tokens."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids_by_doc)
    for doc, ids in ids_by_doc.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert zlib.crc32(bytes(r.ids)) == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and {r.sequence_tokens for r in members} == {at}
        total += at
        padding += window - at if at & (at - 1) else 0
    return padding / max(total, 1)


def secrets(text):
    """Base spans: (start, kind, end)."""
    found = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    for kind, (pattern, least) in enumerate(((r"AKIA[A-Z0-9]+", 20), (r"[0-9a-f]+", 24)), 1):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(found)


def measures(text):
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for i, run in enumerate(runs):
        seen.setdefault(run, []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def simhash(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    """For each value the least place it reaches over links."""
    least = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(values)), 2):
            if least[i] != least[j] and linked(values[i], values[j]):
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return least


def close(a, b):
    return (a ^ b).bit_count() <= 3


def merge(piece, ranks):
    """Byte-level BPE of one piece: the leftmost pair of least rank, again and again."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == 1 << 40:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def top_segments(scores):
    """Maximal scoring segments by their definition: the best, shortest segment, then left and right of it."""

    def best(low, high):
        found = max(
            ((sum(scores[a:b]), a - b, a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,)
        )
        if found[0] <= 0:
            return []
        total, _, a, b = found
        return [*best(low, a), (a, b, total), *best(b, high)]

    return best(0, len(scores))


def signed(number):
    return number - (1 << 64) if number >> 63 else number


def imatch(texts, subsets, common, rare, least):
    """I-Match of each text: its hashes as text, under the lexicon of all texts."""
    import regex

    found = [{signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", t.lower())} for t in texts]
    counts = {}
    for terms in found:
        for term in terms:
            counts[term] = counts.get(term, 0) + 1
    lexicon = {term for term, n in counts.items() if max(2, rare * len(texts)) <= n <= common * len(texts)}

    def hashes(terms):
        known = terms & lexicon
        used = sorted(known if len(known) >= least else terms)
        out = []
        for size, count, bit in subsets:
            for subset in range(count):
                h, held = 42, [t for t in used if (t % (1 << 64)) >> bit & (size - 1) == subset]
                for term in held:
                    h = xxhash.xxh64_intdigest((term % (1 << 64)).to_bytes(8, "little"), h)
                out.append(h if held else 0)
        return out

    return lexicon, lambda text: hashes({signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", text.lower())})


def likeness(one, other):
    judged = [(a, b) for a, b in zip(one, other) if a or b]
    return sum(a == b for a, b in judged) / len(judged) if judged else 1.0


def toxic_forms(text):
    """The distinct words of a text, marked, and their beginnings of 3 to 8 letters."""
    import regex

    words = set(regex.findall(r"[\p{L}\p{M}]+", text.lower()))
    return {"=" + w for w in words} | {w[:n] for w in words for n in range(3, 9) if n <= len(w)}


def toxic_weights(texts, prior, clarity):
    """Weights from (text, toxic): {form: (bound, clarity)}."""
    import math

    n_toxic = sum(toxic for _, toxic in texts)
    n_clean = len(texts) - n_toxic
    counts = {}
    for text, toxic in texts:
        for form in toxic_forms(text):
            t, seen = counts.get(form, (0, 0))
            counts[form] = t + toxic, seen + 1
    weights = {}
    for form, (t, seen) in counts.items():
        if seen < 3:
            continue
        c, share = seen - t, prior * seen / len(texts) + 0.5
        delta = math.log((t + share) / (n_toxic + prior - t)) - math.log((c + share) / (n_clean + prior - c))
        spread = math.sqrt(1 / (t + share) + 1 / (c + share))
        gain = sum(n * math.log(n / (seen * total / len(texts))) for n, total in ((t, n_toxic), (c, n_clean)) if n)
        clear = math.copysign(math.sqrt(max(2 * gain, 0.0)), delta)
        if abs(clear) >= clarity:
            weights[form] = math.copysign(max(abs(delta) - spread, 0.0), delta), clear
    return weights


def toxic_score(model, text):
    """Score and passages (first word, behind last) of a text, from the definition of its segments."""
    import math
    import re as plain_re

    words = plain_re.findall(r"[^\W\d_]+", text.lower())

    def entry(word):
        forms = ["=" + word, *(word[:n] for n in range(3, 9) if n <= len(word))]
        known = [model.weights[f] for f in forms if f in model.weights]
        return model.drift + (max(known, key=lambda k: abs(k[1]))[0] if known else 0.0)

    found = sorted(top_segments([entry(w) for w in words]))
    rarity = [model.rate * s - math.log(model.scale * max(len(words), 1)) for _, _, s in found]
    best = max(-20.0, min(20.0, max(rarity, default=-20.0)))
    base, first, second = model.curve
    x = base + first * best + second * math.log1p(sum(r for r in rarity if r > 0))
    passages = [(a, b) for (a, b, _), r in zip(found, rarity) if math.exp(-max(r, -700)) < model.max_expected]
    return 1 / (1 + math.exp(-max(-30, min(30, x)))), passages
