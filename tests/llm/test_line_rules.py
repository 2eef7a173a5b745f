from collections import Counter

from claimloom.llm.line_rules import line_rules, remove_lines


def plain(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    words = [w for w in text.translate({ord(c): " " for c in spaces}).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(spaces)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed
    )


def test_counts_like_a_plain_reading(small, edge):
    for docs in (small, edge):
        columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        got = Counter((r.doc_id, *(r[c] for c in columns)) for r in line_rules(docs).collect())
        assert got == Counter((r.doc_id, *plain(r.text)) for r in docs.collect())


def test_frequent_lines_go_and_depleted_documents_fail(spark):
    own = lambda i: " ".join(f"d{i}w{k}" for k in range(60))
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(i, f"{own(i)}\n  {passage.upper()}", "h", "x") for i in range(40)]  # more than half is the passage
    rows += [(100 + i, f"{own(i)} {own(i + 50)}\nshort  LINE", "h", "x") for i in range(40)]
    rows += [(200 + i, f"{own(i)}x\n{passage}", f"h{i}", "x") for i in range(40)]  # one document of each host
    rows += [(300, f"{own(7)}y\n{passage}", None, "x")] * 35  # one document, many rows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, removed string")
    verdicts = line_rules(docs)
    kept = {r.doc_id: r.kept for r in verdicts.collect()}
    assert not any(kept[i] for i in range(40)) and all(kept[100 + i] and kept[200 + i] for i in range(40)) and kept[300]
    clean = remove_lines(docs, verdicts)
    assert clean.columns == docs.columns and clean.count() == 80 + 35
    assert {r.text for r in clean.where("doc_id = 105").collect()} == {f"{own(5)} {own(55)}"}
    assert "p79" in clean.where("doc_id = 201").first().text


def test_edge_rows_are_judged(edge, nothing):
    assert line_rules(edge).count() == edge.count()
    kept = line_rules(edge).where("kept")
    assert {r.doc_id for r in kept.collect()} == {6, 7}
    assert remove_lines(edge, line_rules(edge)).columns == edge.columns
    assert line_rules(nothing).count() == 0
