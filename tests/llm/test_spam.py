import random

import numpy as np

from strandloom.llm import spam as S

rnd = random.Random(8)
NOUNS = ["harbour", "budget", "school", "bridge", "ferry", "clinic", "forest", "market", "library", "pension", "railway", "granary", "archive", "customs", "voter", "tenant", "island", "survey", "mortgage", "orchard"]
VERBS = ["repair", "fund", "close", "extend", "reform", "review", "delay", "support", "abandon", "inspect", "record", "publish"]
KEYS = ["cheap flooring", "rent a van", "phone covers", "herbal tea", "fast loan", "kitchen taps", "winter boots"]


def speech(n):
    return " ".join(f"I would like to {rnd.choice(VERBS)} the {rnd.choice(NOUNS)} of this town, and we will {rnd.choice(VERBS)} it with the {rnd.choice(NOUNS)} in the {rnd.choice(NOUNS)}." for _ in range(n))


def stuffing(n, kind):
    words = rnd.sample(KEYS, 4)
    pick = lambda: rnd.choice(words)
    if kind == 0:
        return ", ".join(pick() for _ in range(n))
    if kind == 1:
        return " ".join("#" + pick().title().replace(" ", "") for _ in range(n))
    if kind == 2:
        return "<ul>" + "".join(f'<li><a href="http://shop{i}.test/{pick().replace(" ", "+")}">{pick()}</a></li>' for i in range(n)) + "</ul>"
    if kind == 3:
        return " ".join(f"[{pick()}](https://www.mall{i}.example/{pick().replace(' ', '-')})" for i in range(n))
    return "  ".join(f"{pick()} ({rnd.randint(1, 300)})" for _ in range(n))


def votes(n):
    return "Division No. 7\nAyes: " + "; ".join(f"{rnd.choice(['Mr', 'Ms', 'Dr'])} {''.join(rnd.choices('bdfgklmnprst', k=3))}{rnd.choice('aeiou')}{''.join(rnd.choices('lnrst', k=2))}" for _ in range(n))


def papers(n):
    return "Papers laid: " + "; ".join(f"report on the {rnd.choice(NOUNS)} of the committee (paper {rnd.randint(1, 900)})" for _ in range(n))


def corpus():
    rows, truth = [], {}
    for i in range(900):
        draw = rnd.random()
        if draw < 0.1:
            text, spam = stuffing(rnd.randint(20, 60), rnd.randint(0, 4)), True
        elif draw < 0.16:
            text, spam = speech(2) + " " + stuffing(60, 0), True
        elif draw < 0.2:
            text, spam = speech(14) + " " + stuffing(6, 0), False
        elif draw < 0.27:
            text, spam = (votes if rnd.random() < 0.5 else papers)(rnd.randint(8, 30)), False
        else:
            text, spam = speech(rnd.randint(2, 14)), False
        rows.append((i, text, rnd.choice(["en", "EN", "de", None]), "x", 1.0))
        truth[i] = spam
    return rows, truth


SCHEMA = "doc_id bigint, text string, lang string, language string, distance double"


def test_accuracy_held_out(spark):
    rows, truth = corpus()
    extra = [(2000, None, "en", "x", 1.0), (2001, "", "en", "x", 1.0), (2002, "12", "en", "x", 1.0), (2003, "...", None, "x", 1.0), (2004, speech(4000), "en", "x", 1.0), rows[5]]
    docs = spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, "spam" if truth[i] else "ok", 0) for i in range(0, 900, 5)] + [(4, None, 0), (99_999, "spam", 0)], "doc_id bigint, label string, words int")
    got = {r.doc_id: r.spam for r in S.stuffed(docs, "doc_id", labels).collect()}
    held = [i for i in truth if i % 5]
    right = sum(got[i] and truth[i] for i in held)
    assert right / sum(got[i] for i in held) >= 0.95 and right / sum(truth[i] for i in held) >= 0.95
    assert not got[2004] and not got[2002] and not {2000, 2001, 2003} & set(got)
    few = {r.doc_id: r.spam for r in S.stuffed(docs, "doc_id", labels.limit(0)).collect()}
    told = [i for i, text, *_ in rows if not text.startswith(("Division", "Papers"))]  # what a list of the house is, only reviewed pages say
    assert sum(few[i] == truth[i] for i in told) / len(told) >= 0.95


def test_empty_tables(spark):
    labels = spark.createDataFrame([(1, "spam")], "doc_id bigint, label string")
    assert S.stuffed(spark.createDataFrame([], SCHEMA), "doc_id", labels).collect() == []


def test_words_and_links():
    words, links = S.words_of('See <a href="http://a.test/x+y">rent a van</a> #FastLoan www.b.test/kitchen-taps skös-\ntaern 12')
    assert links == 3 and words == ["see", "rent", "a", "van", "fast", "loan", "kitchen", "taps", "sköstaern", "12"]


def test_features_do_not_depend_on_neighbours():
    v = S.Vocabulary()
    texts = [speech(3), stuffing(30, 0), None, "", "alpha", votes(9)]
    n, language, x = S.describe(texts, v)
    for i, t in enumerate(texts):
        m, one, y = S.describe([t], S.Vocabulary())
        assert m[0] == n[i] and one[0] == language[i] and np.allclose(x[i], y[0], equal_nan=True)


def test_pages_of_bare_links(spark):
    rows, truth = corpus()
    lists = [
        "\n".join(f"https://shop{i}.example" for i in range(30)),
        " ".join(f"www.mall{i}.example" for i in range(30)),
        "".join(f'<a href="https://shop{i}.example/"><img src="{i}.png"></a>' for i in range(30)),
        "\n".join(["https://one.example"] * 30),
    ]
    docs = spark.createDataFrame(rows + [(3000 + i, t, None, "x", 1.0) for i, t in enumerate(lists)] + [(3100, "<br> ... <hr>", None, "x", 1.0)], SCHEMA)
    labels = spark.createDataFrame([(i, "spam" if truth[i] else "ok") for i in range(0, 900, 5)], "doc_id bigint, label string")
    for known in (labels, labels.limit(0)):
        got = {r.doc_id: r for r in S.stuffed(docs, "doc_id", known).collect()}
        assert all(got[3000 + i].spam and got[3000 + i].words == 30 and got[3000 + i].density == 1.0 for i in range(4)) and 3100 not in got


def test_listed_words_come_from_reviewed_pages(spark):
    page = "motion on harbour policy motion on school policy"
    docs = spark.createDataFrame([(i, page) for i in range(4)] + [(4, "cheap taps cheap taps"), (5, "motion taps motion taps"), (6, None), (7, ""), (8, "taps leak taps leak"), (9, "taps leak taps leak")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "ok") for i in (0, 1, 2, 3, 6, 8, 9, 99)] + [(4, "spam"), (5, "spam"), (7, None)], "doc_id bigint, label string")
    # motion: 4 of 6 pages against 1 of 2 of spam; taps: 2 of 6 against 2 of 2
    assert S.listed_words(docs, "doc_id", "text", labels) == {"motion", "policy", "leak"}
    assert S.listed_words(docs, "doc_id", "text", labels.filter("doc_id not in (2, 3)")) == {"policy", "leak"}
    assert S.listed_words(docs, "doc_id", "text", labels.filter("label = 'ok'")) == {"motion", "policy", "taps", "leak"}
    assert S.listed_words(docs, "doc_id", "text", labels.limit(0)) == frozenset()
