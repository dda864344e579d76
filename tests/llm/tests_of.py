"""Plain versions of operators, shared by tests."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def near_groups(rows, n, percent):
    """The smallest id of each row's component."""
    sets = []
    for _, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0]):
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    low = {}
    for g, (doc_id, _) in zip(group, rows):
        if doc_id is not None:
            low[g] = min(doc_id, low.get(g, doc_id))
    return [low.get(g) for g in group]


def removed(rows, length=50):
    """Texts without repeats; cut characters go piece by piece."""
    least = {}
    for doc_id, text in rows:
        data = text.encode()
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            least[data[i : i + length]] = min(doc_id, least.get(data[i : i + length], doc_id))
    out = []
    for doc_id, text in rows:
        data = text.encode()
        gone = [False] * (len(data) + 1)
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            if least[data[i : i + length]] < doc_id:
                gone[i : i + length] = [True] * length
        pieces, piece = [], bytearray()
        for byte, cut in zip(data, gone):
            if cut:
                pieces.append(bytes(piece))
                piece = bytearray()
            else:
                piece.append(byte)
        out.append("".join(x.decode("utf-8", "ignore") for x in [*pieces, bytes(piece)]))
    return out


def contaminated(text, items, window=13):
    words, hit = WORD.findall(lower(text)), set()
    windows = set()
    for _, item in items:
        tokens = WORD.findall(lower(item))
        size = min(window, len(tokens))
        windows |= {tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)} if tokens else set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
    return len(hit) > 0 and 20 * len(hit) >= len(words)
