import textwrap

import pyarrow as pa
from cases import documents, odd_rows

from pulsemill.llm import licenses
from pulsemill.llm.licenses import TEMPLATES, find_copies, find_licenses, load_notices
from pulsemill.llm.text import split_words


def test_each_notice_is_found_by_its_name_and_prose_is_not(spark):
    prose = "The public road to the general store was long, and the copyright office was closed for the day."
    rows = [(i, f"{prose}\n{notice}\n{prose}") for i, notice in enumerate(TEMPLATES.values())] + [(1000, prose), (1001, "a license is a license")]
    found = {(r["doc_id"], r["license"]) for r in find_licenses(documents(spark, rows)).collect()}
    assert found == set(enumerate(TEMPLATES))


def test_wrapped_notices_are_found(spark):
    names = [name for name in TEMPLATES if "(line)" not in name]
    wrapped = [(w, lead, name) for w in (40, 66, 76) for lead in ("", " * ", "# ", "// ") for name in names]
    rows = [
        (i, "int x;\n" + "\n".join(lead + line for line in textwrap.wrap(TEMPLATES[name], w, break_on_hyphens=False)) + "\nint y;")
        for i, (w, lead, name) in enumerate(wrapped)
    ]
    found = [(r["doc_id"], r["license"]) for r in find_licenses(documents(spark, rows)).collect()]
    assert sorted(found) == [(i, name) for i, (_, _, name) in enumerate(wrapped)]


def test_notices_in_long_lines_lists_and_repeats(spark):
    words = "the river ran past a mill where people had ground their grain since long before anyone there could write it down and ".split()
    prose = " ".join(words * 4)
    names = ["MIT", "Apache-2.0", "BSD", "ISC", "MPL-2.0", "CC0-1.0 (line)", "CC-BY-4.0", "GPL-3.0 (line)", "MIT (line)"]
    line = TEMPLATES["MIT (line)"]
    rows = [(n, f"{prose[:n]} {line} {prose}") for n in (200, 400, 450)]
    rows += [(1000, "\n".join(TEMPLATES[n] for n in names)), (1001, " ".join(TEMPLATES[n] for n in names))]
    rows += [(1002, f"{line}\n{line}"), (1003, f"{line} {prose} {line} {line}"), (1004, f"{TEMPLATES['BSD']}\n" * 200)]
    got = {}
    texts = dict(rows)
    for r in find_licenses(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r["license"])
        assert texts[r["doc_id"]][r["block_start"] : r["block_end"]] == TEMPLATES[r["license"]] and r["differences"] == ""
    expected = {n: ["MIT (line)"] for n in (200, 400, 450)} | {n: sorted(names) for n in (1000, 1001)}
    expected |= {1002: ["MIT (line)"] * 2, 1003: ["MIT (line)"] * 3, 1004: ["BSD"] * 200}
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_a_changed_notice_is_not_hidden_by_its_own_first_line(spark):
    text = TEMPLATES["Apache-2.0"].replace("http:", "https:")
    assert [r["license"] for r in find_licenses(documents(spark, [(1, text)])).collect()] == ["Apache-2.0"]


def test_changed_wording_is_listed(spark):
    text = TEMPLATES["CC-BY-SA-4.0"].replace("licensed", "published")
    row = find_licenses(documents(spark, [(1, f"é\n{text}")])).first()
    assert (row["license"], row["differences"], row["block_start"]) == ("CC-BY-SA-4.0", "-licensed +published", 2)


def test_odd_rows(spark):
    docs = documents(spark, [*odd_rows(), (None, TEMPLATES["MIT"]), (30, TEMPLATES["MIT"]), (30, TEMPLATES["MIT"])])
    assert sorted(str(r["doc_id"]) for r in find_licenses(docs).collect()) == ["30", "30", "None"]
    assert find_licenses(docs.limit(0)).collect() == []


def copies_in(text, notices):
    return [(x.name, x.saved) for x in find_copies(licenses._text_of(split_words(pa.array([text]))), notices)]


def test_other_versions_and_clauses_keep_their_names():
    notices = load_notices(TEMPLATES)
    named = {
        "Licensed under the BSD 2-Clause License.": ["BSD-2-Clause (line)"],
        "Licensed under the BSD 4-Clause License.": [],
        "Licensed under the Apache License, Version 1.1": ["Apache-1.1 (line)"],
        "Licensed under the Apache License, Version 3.0": [],
        "Licensed under CC BY-ND 4.0.": ["CC-BY-ND-4.0 (line)"],
        "Licensed under the Boost Software License, Version 1.0.": ["BSL-1.0 (line)"],
        "// SPDX-License-Identifier: MIT": ["MIT (SPDX)"],
        "SPDX-License-Identifier: Apache-2.0 OR MIT": ["Apache-2.0 OR MIT (SPDX)"],
    }
    for text, names in named.items():
        for around in (text, f"It was a long day for the public. {text} Then the rest of the story went on as before."):
            assert [name for name, _ in copies_in(around, notices)] == names, around


def test_the_ranking_is_by_bytes_saved(monkeypatch):
    notices = load_notices(TEMPLATES)
    text = TEMPLATES["GPL-2.0-or-later"]
    ((name, saved),) = copies_in(text, notices)
    alone, every = licenses.savings(text.encode(), notices)
    assert name == "GPL-2.0-or-later" and saved == max(every)
    # Without what compression tells nothing is proposed; turned round, another notice of the same wording wins.
    same = load_notices({"a": "one two three four five six seven eight nine ten", "b": "One two three four five six seven eight nine ten."})
    assert [n for n, _ in copies_in("One two three four five six seven eight nine ten.", same)] == ["b"]
    assert [n for n, _ in copies_in("one two three four five six seven eight nine ten", same)] == ["a"]
    monkeypatch.setattr(licenses, "savings", lambda stretch, notices: (len(stretch), [0] * len(notices.notices)))
    assert copies_in(text, notices) == []


def test_a_notice_over_the_border_of_pieces_is_found_once(monkeypatch):
    notices = load_notices(TEMPLATES)
    prose = " ".join(["software copy notice public rights license"] * 40)
    text = f"{prose} {TEMPLATES['MIT']} {prose} {TEMPLATES['ISC']} {prose}"
    for piece in (50, 97, 260):
        monkeypatch.setattr(licenses, "PIECE", piece)
        assert [name for name, _ in copies_in(text, notices)] == ["MIT", "ISC"], piece
