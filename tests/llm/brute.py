"""Near-duplicate classes and line chunks by plain loops."""

from collections import Counter, defaultdict


def bag(text):
    words = text.split()
    if len(words) >= 5:
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return Counter([tuple(words)]) if words else Counter()


def classes(texts, similarity=0.8):
    """Class (least position) of each text, by all pairs that share a run of words."""
    bags = [bag(t or "") for t in texts]
    holders = defaultdict(list)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(x, y):
        x, y = sorted((root(x), root(y)))
        parent[y] = x

    empty = [i for i, b in enumerate(bags) if not b]
    for i in empty[1:]:
        join(empty[0], i)
    for i, own in enumerate(bags):
        shared = Counter()
        for run, count in own.items():
            for j, other in holders[run]:
                shared[j] += min(count, other)
            holders[run].append((i, count))
        for j, both in shared.items():
            if both / (own.total() + bags[j].total() - both) >= similarity:
                join(i, j)
    return [root(i) for i in range(len(texts))]


def _worded(text):
    """(line, words, lines without words before it) of the lines with words, and their numbers."""
    out, places, gap = [], [], []
    for n, line in enumerate(text.split("\n")):
        if line.split():
            out.append((line, len(line.split()), tuple(gap)))
            places.append(n)
            gap = []
        else:
            gap.append(line)
    return out, places


def repeated_lines(rows):
    """Per document the line numbers of repeated runs after their first place, by growing every pair of equal lines."""
    texts = {i: _worded(t or "") for i, t in rows}
    holders = defaultdict(list)
    for i in sorted(texts):
        for n, (line, _, _) in enumerate(texts[i][0]):
            holders[line].append((i, n))
    gone = defaultdict(set)
    for held in holders.values():
        for a, (i, n) in enumerate(held):
            for j, m in held[a + 1 :]:
                one, two = texts[i][0], texts[j][0]
                if n and m and one[n - 1][0] == two[m - 1][0] and one[n][2] == two[m][2]:
                    continue  # found from an earlier line
                size = 1
                while n + size < len(one) and m + size < len(two) and one[n + size] == two[m + size]:
                    size += 1
                words = sum(w for _, w, _ in one[n : n + size])
                if words > 50 or (size >= 2 and words >= 20):
                    places = texts[j][1]
                    gone[j].update(range(places[m], places[m + size - 1] + 1))
    return gone


def without_repeats(rows):
    """Texts of (doc_id, text) rows after the repeats of their lines go; the first place of each stays."""
    gone = repeated_lines(rows)
    return {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[i]) for i, t in rows}
