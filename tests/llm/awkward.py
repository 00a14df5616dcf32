"""Documents with everything that may go wrong, and plain versions of what the operators do."""

import random
import re


DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, block long, n_words string, kept_text string, n string, seen int"
)


def prose(seed, n, words="the of and in on that it stone river light house walks tree under".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + ("" if r.random() < 0.7 else str(r.randrange(400))) for _ in range(n))


def texts():
    base = prose(1, 120)
    words = base.split()
    near = words[:]
    near[60] = "changed"
    passage = prose(2, 60)
    line = "A line that many documents hold, word for word"
    return [
        base,
        base,
        " ".join(near),
        base.upper(),
        None,
        "",
        " \t\n ",
        "one",
        "one two three",
        "one two three",
        "one two three four five",
        f"{prose(3, 40)} {passage} {prose(4, 40)}",
        f"{prose(5, 30)}\n{passage}\n{prose(6, 70)}",
        f"{passage} {passage}",
        f"{line}\n{prose(7, 50)}\n  {line.upper()}\t\nshort\n{line}",
        f"{prose(8, 20)}\n{line}\nshort\n\n",
        f"\r\n{line}\r\nübergroße Straße mit Öl\n",
        "übergroße Straße mit Öl\nÜBERGROSSE",
        prose(9, 30_000),
        "x" * 70_000 + " tail " + "y" * 70_000,
        "\n".join(["same line again and again"] * 50),
        "a b c " * 100,
        "日本語 のテキスト \u0085  nbsp <|endoftext|> ok '' ’s I'll 1² ½",
        "\x1c\x1d weird \x0b separators \x0c here",
    ]


def rows():
    out = [(k, t, "en", "src0", 0 if t is None else len(t), k % 3, "x", None, "y", 1) for k, t in enumerate(texts())]
    out[8] = (8, out[8][1], None, None, None, None, None, None, None, None)
    out.append(out[0])  # a repeated row
    out.append((14, out[15][1], "en", "src1", 5, 1, "x", "k", "y", 2))  # an id with two texts
    out.append((None, texts()[0], "en", "src1", 5, 1, "x", "k", "y", 2))
    out.append((None, "A LINE THAT MANY documents hold, word for word\n\nnull id", "en", None, 5, 1, "x", "k", "y", 2))
    return out


def frame(spark, parts=3):
    return spark.createDataFrame(rows(), DOCS).repartition(parts, "text")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def plain_substring(texts, window):
    """(n_words, kept words) of each text."""
    found = [words_of(t) for t in texts]
    places = {}
    for d, words in enumerate(found):
        for i in range(len(words) - window + 1):
            places.setdefault(tuple(words[i : i + window]), []).append((d, i))
    gone = [set() for _ in found]
    for where in places.values():
        if len(where) > 1:
            for d, i in where:
                gone[d].update(range(i, i + window))
    return [(len(w), [x for k, x in enumerate(w) if k not in g]) for w, g in zip(found, gone, strict=True)]


def plain_lines(rows, least=10):
    """(n_lines, kept text) of each (id, text); a null id comes last."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    order = lambda id: (id is None, id or 0)
    holders = {}
    for id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(order(id))
    out = []
    for id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(id)]
        out.append((len(lines), "\n".join(kept)))
    return out


def shingles(text, width=5):
    words = words_of(lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_groups(rows, width=5, percent=80):
    """(n_shingles, component id, number of the group's rows) of each (id, text)."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    out = [None] * len(rows)
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        for k in members:
            out[k] = (len(sets[k]), min(ids) if ids else None, members)
    return out
