from odd import documents, nothing

from tiercast.llm import licenses


def brute(text):
    best, lines = (0.0, 0, None), 0
    for line in (text or "").split("\n"):
        grams = set(licenses.bigrams(line))
        scores = []
        for place, (name, notice) in enumerate(licenses.NOTICES.items()):
            template = set(licenses.bigrams(notice))
            scores.append((2 * len(grams & template) / (len(grams) + len(template)), -place, name))
        top = max(scores)
        if top[0] >= licenses.LEAST_DICE:
            lines += 1
            best = max(best, top)
    return (best[2], best[0] if best[2] else None, lines)


def texts(spark):
    notices = list(licenses.NOTICES.values())
    rows = [(i, notice) for i, notice in enumerate(notices)]
    rows += [
        (100, "intro\n" + notices[0].upper() + "\n\n" + notices[1] + "\nend"),
        (101, notices[3].replace("Public", "Free")),
        (102, notices[3].replace("Public License", "")),
        (103, "the the the the the the the the"),
        (104, "MIT License"),
        (105, "Released under the MIT License. And much more text that has nothing to do with it."),
        (106, None),
        (107, ""),
        (108, notices[1] + "\n" + notices[1]),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_equals_brute_force(spark):
    for frame in (texts(spark), documents(spark), texts(spark).unionAll(texts(spark))):
        given = sorted(((r.doc_id, *brute(r.text)) for r in frame.collect()), key=repr)
        found = sorted((tuple(r) for r in licenses.scan_licenses(frame).collect()), key=repr)
        assert found == given


def test_notices_are_found(spark):
    found = {row.doc_id: row.license for row in licenses.scan_licenses(texts(spark)).collect()}
    assert [found[i] for i in range(len(licenses.NOTICES))] == list(licenses.NOTICES)
    assert found[105] is None


def test_nothing(spark):
    assert licenses.scan_licenses(nothing(spark)).isEmpty()
