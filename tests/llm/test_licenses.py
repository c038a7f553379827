import re

from monthfusion.llm import licenses as l

PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = sorted((k, name) for phrase, name in PHRASES for k in range(len(words)) if tuple(words[k : k + len(phrase)]) == phrase)
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({n for _, n in places}))


def result(spark, df):
    return [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels), r.labels, r.score) for r in l.scan(spark, df).collect()]


NOTICE = l.TEMPLATES[3].text


def test_places_and_notices(spark):
    texts = [
        "The MIT License, MIT-license; apache license", "GNU General Public License v3 general public", "mit", "licence of mit license" * 50, None, "", "É mit\nLICENSE中",
        NOTICE.upper(), NOTICE.replace("charge to", "charge oh my to"), " ".join(NOTICE.split()[:4]), "Licensed under CC BY-NC 4.0.", "mit license all rights reserved",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: (base, labels, score) for i, base, labels, score in result(spark, df)}
    for i, text in enumerate(texts):
        assert got[i][0] == brute(text), text
    assert got[7][1:] == ("mit", 1.0) and got[8][1] == "mit" and 0.6 <= got[8][2] < 1
    assert got[9][1:] == ("", 0.0) and got[10][1:] == ("cc-by-nc", 1.0) and got[11][1] == "mit,proprietary"


def test_awkward_rows_and_given_tables(spark, awkward, empty):
    for df in (awkward, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        want = sorted(((r.doc_id, brute(r.text)) for r in df.collect()), key=str)
        assert sorted(((i, base) for i, base, _, _ in result(spark, df)), key=str) == want
    assert result(spark, empty) == []


def plain_score(text, template):
    """Best share of runs in order, by trying every window of the text as a span."""
    words, t = text.split(), template.text.split()
    run, n = l.run_length(template), len(t) - l.run_length(template) + 1
    spots = [(p, q) for p in range(len(words) - run + 1) for q in range(n) if words[p : p + run] == t[q : q + run]]
    best = {}
    for p, q in sorted(spots, key=lambda s: (s[0], -s[1])):
        best[p, q] = 1 + max([v for (a, b), v in best.items() if a < p and b < q] or [0])
    return max(best.values(), default=0) / n


def test_inserted_dropped_and_reordered_words(spark):
    t = (l.TEMPLATES[3],)
    words = NOTICE.split()
    half = len(words) // 2
    changed = {f"in{k}": words[:half] + [f"new{i}" for i in range(k)] + words[half:] for k in range(1, 11)}
    changed |= {f"at{k}": words[:k] + ["one", "two", "three", "four"] + words[k:] for k in range(1, len(words))}
    changed |= {f"out{k}": words[:half] + words[half + k :] for k in range(1, 7)}
    changed |= {"turned": words[half:] + words[:half], "backwards": words[::-1], "apart": words[:half] + ["x"] * 40 + words[half:]}
    df = spark.createDataFrame([(i, " ".join(["before"] * 7 + w + ["after"] * 3)) for i, w in enumerate(changed.values())], "doc_id long, text string")
    found = {r.doc_id: r.score for r in l.scan(spark, df, t).collect()}
    for i, (name, w) in enumerate(changed.items()):
        plain = plain_score(" ".join(w), t[0])
        if name == "apart":
            assert found[i] == 0
        else:
            assert abs(found[i] - (plain if plain >= l.MIN_SCORE else 0)) < 1e-12, name
        assert (found[i] > 0) == name.startswith(("in", "at")) or name.startswith("out"), name


def test_long_lists_of_templates_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(l, "BROADCAST_ROWS", 0)
    long = " ".join(f"w{i}" for i in range(50_000))
    df = spark.createDataFrame([(1, f"{long} {NOTICE} {long} mit license"), (2, f"{NOTICE} {long[:3000]} {NOTICE}")], "doc_id long, text string")
    got = {i: (base[1], labels, score) for i, base, labels, score in result(spark, df)}
    assert got == {1: (1, "mit", 1.0), 2: (0, "mit", 1.0)}
