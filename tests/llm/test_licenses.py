"""Whole licence texts, as they are wrapped in files and on one line."""

import textwrap

import pytest

from tidewater.llm import licenses

APACHE = """Copyright 2024 The Authors

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MIT = """MIT License

Copyright (c) 2024 The Authors

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GPL = """Copyright (C) 2024 The Authors

This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD = """Copyright (c) 2024, The Authors

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
HEAD = "Copyright (c) 2024 The Authors\n\n"
BSD2 = "\n\n".join(p for p in BSD.split("\n\n") if not p.startswith("3. "))
GPL2 = GPL.replace("either version 3", "either version 2")
AGPL = GPL.replace("GNU General", "GNU Affero General")
LGPL3 = GPL.replace("GNU General", "GNU Lesser General")
LGPL21 = HEAD + """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU Lesser General Public License for more details."""
MPL = HEAD + """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
EPL = HEAD + """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""
ISC = HEAD + """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
ZERO = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
CC0 = HEAD + """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."""
FREE = HEAD + """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
SHARE = HEAD + """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."""
TEXTS = {"Apache-2.0": (APACHE, 4), "MIT": (MIT, 4), "GPL-3.0": (GPL, 5), "BSD-3-Clause": (BSD, 6), "BSD-2-Clause": (BSD2, 5),
         "GPL-2.0": (GPL2, 5), "AGPL-3.0": (AGPL, 3), "LGPL-3.0": (LGPL3, 3), "LGPL-2.1": (LGPL21, 3), "MPL-2.0": (MPL, 2),
         "EPL-2.0": (EPL, 1), "ISC": (ISC, 2), "0BSD": (ZERO, 2), "CC0-1.0": (CC0, 1), "Unlicense": (FREE, 2),
         "CC-BY-SA-4.0": (SHARE, 1)}


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False)
                       for p in text.split("\n\n"))


def forms(text):
    yield text
    for width in (40, 72, 79):
        w = wrapped(text, width)
        yield w
        yield w.replace("\n", "\r\n")
        yield "/*\n" + "\n".join(f" * {x}".rstrip() for x in w.split("\n")) + "\n */\nint main;\n"
        yield "\n".join(f"# {x}" for x in w.split("\n")).replace("#\n", "# \n")
    head, _, body = text.partition("Authors\n\n")
    yield f"{head}Authors\n{wrapped(body, 72)}"          # copyright line right above
    yield body.replace("\n\n", " ")                      # all on one line


@pytest.mark.parametrize("name", TEXTS)
def test_whole_texts(spark, name):
    text, least = TEXTS[name]
    cases = list(forms(text))
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_rows(df).collect()}
    assert [(i, got[i].license, got[i].licenses) for i in range(len(cases))] == [
        (i, name, name) for i in range(len(cases))]
    assert min(got[i].n_sentences for i in range(len(cases) - 1)) >= least
    assert got[len(cases) - 1].n_sentences >= least - 2  # no blank lines: neighbours are one sentence


def test_wrapped_notices_and_neighbours(spark):
    cases = ["This work is licensed under the GNU General\nPublic License, version 3.",
             "prose above\nLicensed under CC BY 4.0\nprose below",
             "Permission is hereby granted, free of charge.\nThe software is provided with care.", None, "", "\n\n\n", "::\x00"]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: (r.n_sentences, r.licenses, r.license) for r in licenses.license_rows(df).collect()}
    none = (0, "", None)
    assert got == {0: (1, "GPL-3.0", "GPL-3.0"), 1: (1, "CC-BY-4.0", "CC-BY-4.0"), 2: none, 3: none, 4: none, 5: none, 6: none}


def test_marks_general_licences_and_clashing_columns(spark):
    cases = ["// SPDX-License-Identifier: GPL-2.0-or-later\nint main;", "# SPDX-License-Identifier: BSD-2-Clause",
             "All rights reserved.", "Licensed under the MIT License.\nAll rights reserved.",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met:\nAll rights reserved.", "SPDX-License-Identifier: Apache-2.0\nSPDX-License-Identifier: MIT"]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(cases)], "doc_id long, text string, _ids int, _all string")
    got = licenses.scan(df).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == ["GPL-2.0", "BSD-2-Clause", "Proprietary", "MIT", "BSD", "Apache-2.0,MIT"]
    assert {(r._ids, r._all) for r in got} == {(7, "x")}
