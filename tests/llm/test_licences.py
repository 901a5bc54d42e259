from __future__ import annotations

import textwrap

from clickgauge.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software.
The above copyright notice and this permission notice shall be included in all copies.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""


def found(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["licences"] for r in licences.report(licences.scan(df)).orderBy("doc_id").collect()]


def test_sequences_match_the_longest_rule(spark):
    assert found(spark, MIT, "Words. " + MIT + "\nLicensed under CC BY-NC 4.0.", MIT.split("\n")[0], "Released under the MIT License.",
                 "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.\nSee it",
                 "No words on that.", None, "", "A licence to print money") == [
        "MIT", "CC-BY-NC,MIT", "", "MIT", "GPL-3.0", "Apache-2.0", "", "", "", ""]


def test_order_matters(spark):
    lines = MIT.split("\n")
    assert found(spark, "\n".join(reversed(lines))) == [""]


def test_odd_rows(docs, empty, corpus):
    assert licences.report(licences.scan(docs)).count() == len(corpus)
    assert licences.report(licences.scan(empty)).count() == 0


GNU = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free "
       "Software Foundation; either version {} of the License, or (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
       "and/or other materials provided with the distribution.\n\n")
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
                  "copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed "
                  "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                  "specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": BSD + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
    "BSD-3-Clause": BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                          "software without specific prior written permission.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in "
           "the Software without restriction.\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
           "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
           "and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.",
    "GPL-3.0-or-later": GNU.format("", 3), "GPL-2.0-or-later": GNU.format("", 2), "LGPL-2.1": GNU.format("Lesser ", "2.1"), "LGPL-3.0": GNU.format("Lesser ", 3),
    "AGPL-3.0": GNU.format("Affero ", 3),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3, and no other.", "GPL-2.0": "You may copy it under the GNU General Public License v2.",
    "GPL": "It falls under the GNU General Public License.", "BSD": "Use of this file is governed by terms under a BSD-style license found elsewhere.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
               "obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-ND": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA": "Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA": "Text is available under the Creative Commons Attribution-ShareAlike License.", "CC-BY-ND": "Licensed under CC BY-ND 4.0.", "CC-BY": "Licensed under CC BY 4.0.",
    "CC0-1.0": "To the extent possible under law, all rights are waived under Creative Commons Zero.", "Public-Domain": "This code was released into the public domain by its author.",
}


def wrapped(text, mark=""):
    return "\n".join(f"{mark}{line}".rstrip() for block in text.split("\n") for line in (textwrap.wrap(block, 58) or [""]))


def test_every_rule_fires_on_its_notice_however_wrapped(spark):
    assert set(NOTICES) == {name for name, ids in licences.RULES if not ids[0].startswith("spdx")}
    for form in (lambda t: t.replace("\n\n", " "), wrapped, lambda t: "/*\n" + wrapped(t, " * ") + "\n */\nint main;", lambda t: wrapped(t, "// "), lambda t: wrapped(t, "# ")):
        texts = ["Copyright (c) 2020 Jane Doe\n" + form(t) for t in NOTICES.values()]
        assert dict(zip(NOTICES, found(spark, *texts))) == {n: n for n in NOTICES}


def test_spdx_lines(spark):
    texts = [f"// SPDX-License-Identifier: {name}\n// Copyright 2020 Jane\ncode" for name, _ in licences.SPDX] + ["SPDX-License-Identifier: MITX", "SPDX-License-Identifier:\tMIT"]
    assert found(spark, *texts) == [name for name, _ in licences.SPDX] + ["", "MIT"]


def test_very_long_text(spark):
    assert found(spark, "word " * 200_000 + ". " + wrapped(NOTICES["MIT"]) + "\n\n" + "line\n" * 100_000) == ["MIT"]
