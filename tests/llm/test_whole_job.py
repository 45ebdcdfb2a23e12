"""Cases beyond the tables: pages without links, wrapped notices, account numbers as people print them."""

import dataclasses

import numpy as np
import pytest

from creditloom.llm import hmm_lm, html_text, license_scan, pii

PARAGRAPH = "The lender weighs every application against the history of the applicant, and keeps the reasons beside the answer. " * 4
ARTICLE = f"<article><h1>On lending</h1>{''.join(f'<p>{i}. {PARAGRAPH}</p>' for i in range(6))}</article>"
LEGAL = '<div class="legal">Offer void where prohibited.</div><div class="x1">Figures without warranty.</div>'


def test_unnamed_boilerplate_without_links():
    wanted = html_text.main_text(f"<body>{ARTICLE}</body>")
    assert wanted.startswith("On lending\n0. The lender") and wanted.count("\n") == 6
    nav = "<nav><ul>" + "".join(f'<li><a href="/{i}">page {i}</a></li>' for i in range(6)) + "</ul></nav>"
    one = '<nav><a href="/">x</a></nav>'
    for menu in ("", one, nav):
        assert html_text.main_text(f"<body>{menu}{ARTICLE}{LEGAL}</body>") == wanted
        assert html_text.main_text(f"<body>{menu}<div><div>{LEGAL}</div>{ARTICLE}</div></body>") == wanted


def test_densities_without_links_are_not_zero():
    order = html_text.measure(html_text.parse(f"<body>{ARTICLE}{LEGAL}</body>"))
    assert all(n.density > 0 for n, _ in order if n.chars > 1)


def test_share_of_links_in_furniture():
    body = html_text.parse("<body><nav><a>abcd</a></nav><script>var unseen</script><p>efgh</p></body>")
    assert html_text._link_share(body) == 0.5


def test_class_word_on_the_main_text():
    wanted = html_text.main_text(f"<body>{ARTICLE}</body>")
    assert html_text.main_text(f'<body><div class="widget"><div id="banner">{ARTICLE}<div class="ad">{PARAGRAPH}</div></div></div></body>') == wanted
    links = '<a href="/">one of very many links</a>' * 200
    assert html_text.main_text(f'<body><div class="menu">{links}</div>{ARTICLE}</body>') == wanted
    plain = "".join(f"<p>{i}. {PARAGRAPH}</p>" for i in range(6))
    assert html_text.main_text(f'<body><div class="content widget">{plain}</div><p>End.</p></body>').count("The lender") == 24
    assert html_text.main_text(f'<body><article><h1>On lending</h1><div class="social">{plain}</div></article></body>').count("The lender") == 24
    assert html_text.main_text(f'<body><div class="ad">{PARAGRAPH}</div><article><p>Short.</p></article></body>') == "Short."


GPL = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License"


def names(text):
    return sorted({n for _, _, n in license_scan.Scanner().scan(text)})


def test_every_license_of_a_block():
    gpl = "This work is licensed under the GNU General Public License, version 3."
    assert names(f"Copyright 2020 Foo. All rights reserved.\n{gpl}") == ["GPL-3.0", "proprietary"]
    assert names(f"Released under the MIT License.\n{gpl}") == ["GPL-3.0", "MIT"]
    everything = [n for notices in license_scan.TEMPLATES.values() for n in notices]
    assert names("\n".join(f"{n} (license)" for n in everything)) == sorted(license_scan.TEMPLATES)
    far = " ".join(f"w{i % 977}" for i in range(9000))
    assert names(f"license {far} All rights reserved. {far} Licensed under CC BY 4.0. {far}") == ["CC-BY-4.0", "proprietary"]


def test_words_that_tell_licenses_apart():
    assert names(GPL.format("", 2)) == ["GPL-2.0"] and names(GPL.format("", 3)) == ["GPL-3.0"]
    assert names(GPL.format("Lesser ", 3)) == names(GPL.format("Affero ", 3)) == names(GPL.format("", 1)) == ["unknown"]
    assert names(GPL.format("", 3).replace("as published", "(GPL) as published")) == ["GPL-3.0"]
    assert names(GPL.format("", 3).replace("Free Software Foundation", "FSF")) == ["unknown"]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_wrapped_notices():
    headers = {"MIT": MIT, "BSD-3-Clause": BSD, "MPL-2.0": MPL, "GPL-2.0": GPL_HEADER}
    for name, header in headers.items():
        for sign in ("", "# ", " * ", "// "):
            lines = "\n".join(sign + line for line in header.split("\n"))
            assert names(lines) == names(f"one\ntwo\n\n{lines}\n\nthree") == names(f"one\n{lines}\nthree") == [name]
    wrapped = "\n".join(license_scan.TEMPLATES["Apache-2.0"][0].split())  # a word a line
    assert license_scan.Scanner().scan(f"one\n{wrapped}\ntwo") == [(4, 4 + len(wrapped), "Apache-2.0")]
    assert names("all rights\nreserved") == ["proprietary"]


def test_bounds_of_wrapped_notices():
    scan = license_scan.Scanner().scan
    assert scan(f"one\n\n{GPL_HEADER}\n\ntwo") == [(5, 5 + len(GPL_HEADER), "GPL-2.0")]
    assert scan(f"{MPL}\n\nplain\n\nreleased under the\nMIT license") == [(0, len(MPL), "MPL-2.0"), (len(MPL) + 9, len(MPL) + 39, "MIT")]
    assert scan("plain\nown license\nplain\n\nplain") == [(6, 17, "unknown")]


SECRETS = [
    "IBAN: [DE89 3704 0044 0532 0130 00] is mine", "IBAN [DE89370400440532013000].", "iban=[GB82 WEST 1234 5698 7654 32], ok", "account: [NL91 ABNA 0417 1643 00]",
    "Iban [NO93 8601 1117 947] 12", "IBAN: DE88 3704 0044 0532 0130 00", "IBAN: DE89 3704 0044 0532 0130 001", "IBAN follows",
    "account: [12345678]", "account number is [1234567890].", "account no.: [1234-5678-90]", "Account #[12 34 56 78] x", "account [1234567890]", "account: [AB12345678]",
    "account: [X_12345678/9]", "account: [40-47-84 70872490]", "account of 2023 10 05", "account: 12345", "accounts 2023", "account: [1234567890123456789012]", "account: 1234567890123456789012345",
    "ssn: [123-45-6789]", "SSN [123 45 6789]", "ssn is [123456789],", "ssn: 123-45-678", "ssn: 1234567890",
    "password: [hunter22]", "password: [p@ss!]", "pwd='[correct horse]'", "password is [abc123].", "passwd=[Tr0ub4dor&3]", "password: required", "password protected", "secret: [s3cr3t]",
    'token = "[99dbebab99ab99999d99]"', "token=[aB3dE6gH9]", "token=position1", "api_key: [sk-0123456789abcdef]", "tokens: 12", "mytoken=99dbebab99ab99999d99",
]
LOGINS = ["ftp://[user:pass]@host/x", "https://[a:b-1]@h.de", "https://host/a:b@c", "http://user@host", "x://[u:p]@h y://[v:q]@h"]


def marked(text, kind):
    parts, at = [], 0
    for start, end, _ in (s for s in pii.Finder().spans(text) if s[2] == kind):
        parts += [text[at:start], "[", text[start:end], "]"]
        at = end
    return "".join([*parts, text[at:]])


@pytest.mark.parametrize(("wanted", "kind"), [*((x, "secret") for x in SECRETS), *((x, "login") for x in LOGINS)])
def test_values_of_cues_and_logins(wanted, kind):
    assert marked(wanted.replace("[", "").replace("]", ""), kind) == wanted


def test_states_over_segment_borders():
    rnd, k, c = np.random.RandomState(2), 3, 5
    start, move, emit = (x / x.sum(-1, keepdims=True) for x in (rnd.rand(k), rnd.rand(k, k), rnd.rand(k, c)))
    for size in (1, 6, 7, 8, 50):
        text = rnd.randint(0, c, size).astype("<u2")
        for long, whole in zip(hmm_lm.expected_long(start, move, emit, text, segment=7), hmm_lm.expected(start, move, emit, [text])):
            assert np.allclose(long, whole)
        assert np.isclose(hmm_lm.expected_long(start, move, emit, text, segment=7)[3], hmm_lm.forward(start, move, emit, [text])[0])


def test_training_settles_on_whole_texts(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text")
    model = hmm_lm.initial(hmm_lm.count_words(docs.filter(~hmm_lm.held_out("doc_id"))))
    encoded = hmm_lm.encode(docs, model)
    trained = hmm_lm.baum_welch(encoded, model)
    texts = [np.frombuffer(r[0], dtype="<u2") for r in encoded.filter("NOT held_out").select("classes").collect()]

    def value(m):
        found = hmm_lm.forward(m.start, m.move, m.emit, texts).sum() + hmm_lm.PLAN.smoothing * (np.log(m.start).sum() + np.log(m.move).sum())
        return found + hmm_lm.PLAN.prior_tokens * (np.log(m.emit) @ m.shares).sum()

    sums = [sum(x) for x in zip(*(hmm_lm.expected(trained.start, trained.move, trained.emit, [x])[:3] for x in texts))]
    assert np.isclose(sums[0].sum(), len(texts))
    sums = [sums[0] + hmm_lm.PLAN.smoothing, sums[1] + hmm_lm.PLAN.smoothing, sums[2] + hmm_lm.PLAN.prior_tokens * model.shares]
    again = dataclasses.replace(trained, **{n: x / x.sum(-1, keepdims=True) for n, x in zip(("start", "move", "emit"), sums)})
    assert 0 <= value(again) - value(trained) < 1e-4 * abs(value(trained))
