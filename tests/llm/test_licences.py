import textwrap

from linkloom.llm import licences

MIT = """Copyright (c) 2020 Somebody.

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""  # fmt: skip


def test_every_known_sentence_carries_a_licence_word():
    assert all(any(w in s for w in licences.LICENCE_WORDS) for s in licences.SENTENCES)
    known = set(licences.SENTENCES.values())
    assert all(i in known for _, ids in licences.RULES for i in ids)


def test_rules(spark):
    texts = {
        1: MIT,
        2: "Words. Licensed under the Apache License, Version 2.0.",
        3: "Released under the MIT License.\nAll rights reserved.",
        4: MIT.split("\n\n")[1] + "\n",
        5: "Our licence plates are blue. The license is unclear.",
        6: None,
        7: "",
        8: "x " * 200_000 + "\nLICENSED UNDER CC BY-NC 4.0.",
        9: "This work is licensed under the GNU General Public License, version 3. Released under the MIT License.",
    }
    rows = [(i, t, "x", 0) for i, t in texts.items()] + [(None, texts[2], "x", 0), (2, texts[2], "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licences string, n_known int")
    found = [(r.doc_id, r.licences, r.sentence_ids, r.n_known, r.n_unknown) for r in licences.scan(df).collect()]
    assert sorted(found, key=lambda r: r[0] or 0) == [
        (None, "Apache-2.0", "apacheRef", 1, 0),
        (1, "MIT", "mitGrant;mitNotice;asIs", 3, 1),
        (2, "Apache-2.0", "apacheRef", 1, 0),
        (2, "Apache-2.0", "apacheRef", 1, 0),
        (3, "MIT;All-rights-reserved", "mitRef;allRights", 2, 0),
        (4, "MIT-incomplete", "mitGrant", 1, 0),
        (5, "", "", 0, 2),
        (6, "", "", 0, 0),
        (7, "", "", 0, 0),
        (8, "CC-BY-NC-4.0", "ccByNcRef", 1, 0),
        (9, "GPL-3.0;MIT", "gpl3Ref;mitRef", 2, 0),
    ]
    assert licences.scan(df.where("false")).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = licences.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


#: Genuine notices by rule, and one genuine text of every known sentence that is in none of them.
NOTICES = {
    "MIT": MIT,
    "MIT-incomplete": MIT[: MIT.index("THE SOFTWARE IS")],
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "All-rights-reserved": "All rights reserved.",
}
NOTICES["BSD-2-Clause"] = NOTICES["BSD-3-Clause"][: NOTICES["BSD-3-Clause"].index("3. Neither")]
ONE_LINERS = {
    "MIT": ("Licensed under the MIT License.", "Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License")', "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License: version 2."),
    "MPL-2.0": ("Licensed under the Mozilla Public License, version 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
}


def test_genuine_notices_in_one_line_and_wrapped(spark):
    texts = [*NOTICES.items(), *((name, t) for name, some in ONE_LINERS.items() for t in some)]
    assert {name for name, _ in texts} == {name for name, _ in licences.RULES}
    rows = []
    for name, text in texts:
        blocks = text.strip().split("\n\n")
        rows.append((name, text))
        for width in (12, 40, 72):
            wrapped = ["\n".join(textwrap.wrap(b, width, break_long_words=False, break_on_hyphens=False)) for b in blocks]
            rows.append((name, "\n\n".join(wrapped)))
            rows.append((name, "/*\n" + textwrap.indent("\n\n".join(wrapped), " * ", lambda _: True) + "\n */\r\nint x;\r\n"))
            rows.append((name, textwrap.indent("\n\n".join(wrapped), "# ", lambda _: True).replace("\n", "\r\n")))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(df).collect()}
    assert [(rows[i], r.licences) for i, r in sorted(found.items()) if r.licences != rows[i][0]] == []
    assert {i for r in found.values() for i in r.sentence_ids.split(";")} == set(licences.SENTENCES.values())
    # Only MIT's line of the holder is unknown: nothing else is left over in pieces.
    assert all(r.n_unknown == rows[i][1].count("Somebody") for i, r in found.items())


def test_part_of_a_known_sentence_is_not_known(spark):
    texts = ["SPDX-License-Identifier: MIT-0", "Not\nlicensed under the MIT License today", "SPDX-License-Identifier: MIT OR Apache-2.0", "relicensed under the MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.licences, r.n_known, r.n_unknown) for r in licences.scan(df).collect()} == {("", 0, 1)}
