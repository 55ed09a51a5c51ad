from collections import Counter, defaultdict

from rolelake.llm import lines


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    shown = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(shown) - len(set(shown)), len(covered)
    )


ROWS = [
    (1, "a b c d a b c e", "en", "s"), (2, None, "en", "s"), (3, "", None, None), (4, "x\n\n x\nx\n#|<>&", "en", "s"),
    (5, "a\x1cb c\td e f", "en", "s"), (6, "one two three " * 3000, "en", "s"), (6, "one two three " * 3000, "en", "s"),
    (None, "w " * 60, "en", "t"), (8, "Über ß é " * 40, None, "t"),
]


def test_counts_match_a_plain_version(documents):
    found = lines.verdicts(documents(ROWS)).select("key", "counts.*").collect()
    got = sorted((str(r[0]), *r[1:]) for r in found)
    assert got == sorted((str(r[0]), *brute_counts(r[1])) for r in ROWS)


def test_lines_above_limits_go_and_depleted_documents_are_rejected(documents, prose):
    footer = "Page 12 of the daily   news"
    rows = [(i, f"{prose(i, 60)}\n{footer.replace('12', str(i + 10))}", "en", "a") for i in range(30)]
    rows += [(100, "\n".join(["PAGE 77 OF THE DAILY NEWS"] * 20), "en", "a"), (101, f"{prose(5, 60)}\n{footer}", "en", "b")]
    docs = documents(rows)
    got = {r["key"]: r for r in lines.verdicts(docs).collect()}
    assert all(got[i]["n_lost"] == 6 and not got[i]["depleted"] for i in range(30))
    assert got[100]["depleted"] and got[101]["n_lost"] == 0
    kept = {r["doc_id"]: r["text"] for r in lines.cleaned(docs).collect()}
    assert set(kept) == {*range(30), 101}
    assert kept[3] == prose(3, 60) and footer in kept[101]


def test_copies_are_no_reason_to_remove_their_lines(documents, prose):
    rows = [(i, prose(0, 80), "en", "a") for i in range(60)] + [(100 + i, prose(i + 1, 80), "en", "a") for i in range(10)]
    assert lines.cleaned(documents(rows)).count() == 70


def test_counts_of_documents_per_line_match_a_plain_version(documents, prose):
    rows = [(i, "\n".join(f"{prose(k, 4)}" for k in range(i % 7, i % 7 + i % 5)), "en", f"s{i % 3}" if i % 4 else None) for i in range(200)]
    facts = lines._facts(documents(rows), "doc_id", "source", "text")
    limits = lines.Limits(documents=3, share=0.2)
    by, hosts = defaultdict(set), defaultdict(set)
    for _, text, _, source in rows:
        hosts[source].add(text)
        for line in text.split("\n"):
            if line:
                by[source, line].add(text)
    want = Counter(s for (s, _), texts in by.items() if len(texts) > 3 and len(texts) > 0.2 * len(hosts[s]))
    assert Counter(r["host"] for r in lines.frequent_lines(facts, limits).collect()) == want


def test_empty_table(documents):
    assert lines.verdicts(documents([])).count() == 0
    assert lines.cleaned(documents([])).columns == documents([]).columns
