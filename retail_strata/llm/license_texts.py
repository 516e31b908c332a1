"""Licence notices and texts as template markup, and phrases that name a licence.

``<<beginOptional>>`` and ``<<endOptional>>`` enclose words that may be left out; they nest.
``<<var;name=n;match=re;words=lo-hi>>`` stands for lo to hi words that each match ``re`` in full
(any word and exactly one if not said). All other words are mandatory. Case, punctuation and
white space do not count.
"""

from __future__ import annotations

# Phrases and the labels that they give.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_OPENING = "<<beginOptional>>this <<var;name=work;words=1-3>> is<<endOptional>>"
_UNDER = "<<var;name=verb;match=licensed|released|distributed|available|published>> under"
_HOLDER = "<<beginOptional>>copyright <<var;name=holder;words=0-24>><<endOptional>>"
_AS_IS = """
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
    BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
    NONINFRINGEMENT. IN NO EVENT SHALL THE
    <<var;name=parties;match=authors|author|or|copyright|holders|holder|x|consortium;words=1-6>>
    BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
    IN THE SOFTWARE.
"""
_BSD = """
    Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met:
    <<var;name=bullet;match=1|a|i;words=0-1>> Redistributions of source code must retain the above
    copyright notice, this list of conditions and the following disclaimer.
    <<var;name=bullet;match=2|b|ii;words=0-1>> Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution.
"""
_ENDORSE = """
    <<var;name=bullet;match=3|c|iii;words=0-1>> Neither the name of
    <<var;name=holder;words=1-24>> may be used to endorse or promote products derived from this
    software without specific prior written permission.
"""
_BSD_END = """
    THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-24>> "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""

#: ``(name, label, markup)``. Several templates may give one label.
TEMPLATES = [
    (
        "mit-notice",
        "mit",
        f"{_OPENING} {_UNDER} the <<beginOptional>>terms of the<<endOptional>> MIT License",
    ),
    (
        "mit-text",
        "mit",
        f"""<<beginOptional>>The MIT License <<beginOptional>>MIT<<endOptional>><<endOptional>>
        {_HOLDER}
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all
        copies or substantial portions of the Software. {_AS_IS}""",
    ),
    (
        "isc-text",
        "isc",
        f"""<<beginOptional>>ISC License<<endOptional>> {_HOLDER}
        Permission to use, copy, modify, <<beginOptional>>and/or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.""",
    ),
    ("bsd-2-text", "bsd-2-clause", f"{_HOLDER} <<beginOptional>>All rights reserved.<<endOptional>> {_BSD} {_BSD_END}"),
    ("bsd-3-text", "bsd-3-clause", f"{_HOLDER} <<beginOptional>>All rights reserved.<<endOptional>> {_BSD} {_ENDORSE} {_BSD_END}"),
    (
        "apache-2-notice",
        "apache-2.0",
        f"""{_OPENING} {_UNDER} the Apache License <<beginOptional>>Version<<endOptional>> 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at
        <<var;name=address;words=1-8>><<endOptional>>""",
    ),
    *[
        (
            f"{label}-notice",
            label,
            f"""{_OPENING}
            <<beginOptional>>free software you can redistribute it and or modify it<<endOptional>>
            <<var;name=verb;match=licensed|released|distributed|available|published;words=0-1>>
            under the <<beginOptional>>terms of the<<endOptional>> GNU {kind}
            <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
            <<beginOptional>>either<<endOptional>> version {version}
            <<beginOptional>>of the License<<endOptional>>
            <<beginOptional>>or (at your option) any later version<<endOptional>>""",
        )
        for label, kind, version in [
            ("gpl-2.0", "General Public License", "2"),
            ("gpl-3.0", "General Public License", "3"),
            ("agpl-3.0", "Affero General Public License", "3"),
            ("lgpl-2.1", "Lesser General Public License", "2.1"),
            ("lgpl-3.0", "Lesser General Public License", "3"),
        ]
    ],
    (
        "mpl-2-notice",
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        <<beginOptional>>If a copy of the MPL was not distributed with this file, You can obtain
        one at <<var;name=address;words=1-8>><<endOptional>>""",
    ),
    *[
        (
            f"{label}-notice",
            f"{label}-4.0",
            f"""{_OPENING} {_UNDER} <<beginOptional>>a<<endOptional>> CC {short}
            <<beginOptional>>version<<endOptional>> 4.0
            <<beginOptional>>International<<endOptional>> <<beginOptional>>license<<endOptional>>""",
        )
        for label, short in [
            ("cc-by", "BY"),
            ("cc-by-sa", "BY-SA"),
            ("cc-by-nc", "BY-NC"),
            ("cc-by-nd", "BY-ND"),
            ("cc-by-nc-sa", "BY-NC-SA"),
            ("cc-by-nc-nd", "BY-NC-ND"),
        ]
    ],
]
