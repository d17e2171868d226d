from cases import documents

from tallyframe.llm.licenses import TEMPLATES, confirmed, license_scan, scan_text, train, words_of

PROSE = ["The river was high and the people of the town went home before the night came.", "Er war nicht zu Hause und das Licht war aus.",
         "a version of the work that he had seen in the park", "Permission was given to the children to use the garden."] * 20


def test_every_template_is_found_and_prose_is_not():
    model = train(PROSE)
    right = total = 0
    for family, wordings in TEMPLATES.items():
        for wording in wordings:
            for text in (wording, f"intro line here\n{wording}\nmore prose follows it", wording.upper()):
                right += family in scan_text(text.encode(), model)[3].split(",")
                total += 1
    assert right >= 0.97 * total
    assert not any(scan_text(p.encode(), model)[2] for p in PROSE)


def test_template_comparison_rejects_what_only_sounds_alike():
    assert not confirmed("MIT", words_of("the license of the MIT was released"))
    assert confirmed("MIT", words_of("Copyright me. Released under the MIT License. Thanks."))


def test_parts_of_a_wrapped_licence():
    model = train(PROSE)
    text = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
            'files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights')
    assert scan_text(text.encode(), model)[3] == "MIT"


def test_odd_rows_planted_lines_and_empty_table(spark):
    docs = documents(spark, clashing=True)
    out = {r["id"]: r for r in license_scan(docs).collect()}
    assert license_scan(docs).count() == docs.count() and not any(r["families"] for r in out.values())
    planted = documents(spark, [(1, "Erst.\nReleased under the MIT License.\nNext.", "en", "s", 0),
                                (2, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "en", "s", 0), (3, None, None, None, None)])
    found = {r["id"]: (r["n_paragraphs"], r["n_confirmed"], r["families"]) for r in license_scan(planted).collect()}
    assert found == {1: (3, 1, "MIT"), 2: (2, 2, "Apache-2.0,CC-BY-NC"), 3: (0, 0, "")}
    assert license_scan(documents(spark, [])).count() == 0


def test_planted_notices_of_the_small_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    want = {r["doc_id"]: ",".join(sorted(f for line, f in lines.items() if line in (r["text"] or ""))) for r in docs.collect()}
    assert {r["id"]: r["families"] for r in license_scan(docs).collect()} == want


def families(model, text):
    return scan_text(text.encode(), model)[3]


def test_notices_that_share_a_line_break_or_hide_in_long_lines():
    model = train(PROSE)
    long = " ".join(PROSE[:40])
    assert families(model, "Licensed under the MIT license. Licensed under the Apache License, Version 2.0.") == "Apache-2.0,MIT"
    assert families(model, "This crate is licensed under either of Apache License, Version 2.0 or MIT license at your option.") == "Apache-2.0,MIT"
    assert families(model, "Licensed under the Apache License,\nVersion 2.0.") == "Apache-2.0"
    assert families(model, "Licensed under\nthe Apache\nLicense, Version\n2.0.") == "Apache-2.0"
    assert families(model, f"{long} This work is licensed under the GNU General Public License, version 3. {long}") == "GPL-3.0"
    assert families(model, f"{long} Licensed under CC BY-NC 4.0. {long}\n\n{long}\nReleased under the\nMIT License. {long}") == "CC-BY-NC,MIT"
    assert families(model, f"{long}\n\n{long}\n{long}") == ""


def test_common_short_wordings():
    model = train(PROSE)
    for text, family in (("License: MIT", "MIT"), ("MIT License", "MIT"), ("BSD 2-Clause License", "BSD"), ("GPLv3", "GPL-3.0"),
                         ("GNU GENERAL PUBLIC LICENSE Version 3", "GPL-3.0"), ("Apache License, Version 2.0", "Apache-2.0")):
        assert families(model, f"intro line here\n{text}\nmore prose follows it") == family, text
    assert families(model, "He said the MIT license was one of many that he had read") == ""


def test_a_wrapped_licence_in_short_lines_and_across_blank_lines():
    model = train(PROSE)
    words = TEMPLATES["ISC"][1].split()
    wrapped = "\n".join(" ".join(words[i : i + 6]) for i in range(0, len(words), 6))
    assert families(model, f"some prose before\n\n{wrapped}\n\nsome prose after") == "ISC"
    apart = "Licensed under the Apache\n\nLicense, Version 2.0."
    assert families(model, apart) == ""  # two paragraphs are no notice
