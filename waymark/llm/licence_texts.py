"""The texts of common licences and notices, as they stand in files, and the names that licences go by."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""

BSD_3 = BSD_2.replace("THIS SOFTWARE", """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE""")

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""

APACHE_2 = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: {0}: the licence's name; {1}: its version.
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details.

You should have received a copy of the {0} along with this program."""

MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""

#: The same as many files have it, with semicolons, and the form that names one version alone.
GNU_SEMICOLONS = GNU.replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")
GNU_ONLY = """This program is free software; you can redistribute it and/or modify it under the terms of the {0} version {1} as published by the Free Software Foundation."""

BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."""

ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""

BSD_4 = BSD_3.replace("3. Neither", """3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization with its permission.

4. Neither""")

POSTGRESQL = """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."""

WTFPL = """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."""

OFL = """This Font Software is licensed under the SIL Open Font License, Version 1.1."""

GNU_NAMES = {"AGPL": "GNU Affero General Public License", "LGPL": "GNU Lesser General Public License", "GPL": "GNU General Public License"}
GNU_VERSIONS = {"AGPL": ["3"], "LGPL": ["3", "2.1"], "GPL": ["3", "2"]}


def gnu_texts() -> dict[str, list[str]]:
    out = {}
    for short, versions in GNU_VERSIONS.items():
        for v in versions:
            forms = [GNU, GNU_SEMICOLONS, GNU_ONLY, *(f.split("\n\n")[0] for f in (GNU, GNU_SEMICOLONS))]
            out[f"{short}-{v if '.' in v else v + '.0'}"] = [f.format(GNU_NAMES[short], v) for f in forms]
    return out


TEXTS = {
    "Apache-2.0": [APACHE_2],
    "BSD-4-Clause": [BSD_4],
    "BSD-3-Clause": [BSD_3],
    "BSD-2-Clause": [BSD_2],
    "MIT": [MIT],
    "ISC": [ISC],
    **gnu_texts(),
    "MPL-2.0": [MPL_2],
    "Unlicense": [UNLICENSE],
    "Zlib": [ZLIB],
    "BSL-1.0": [BOOST],
    "0BSD": [ZERO_BSD],
    "PostgreSQL": [POSTGRESQL],
    "WTFPL": [WTFPL],
    "OFL-1.1": [OFL],
}
#: What follows "licensed under", as license_scans.canonical() leaves it.
NAMES = {
    "MIT": ["mit license", "mit"],
    "BSD": ["bsd license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license"],
    "ISC": ["isc license"],
    "Apache-2.0": ["apache license v2", "apache license 2 0", "apache 2 0 license", "apache 2 0", "apache software license v2"],
    "MPL-2.0": ["mozilla public license v2", "mozilla public license 2 0", "mpl v2", "mpl 2 0"],
    **{f"{short.upper()}-{v.replace(' ', '.')}": [f"{name} {form}" for name in (f"gnu {long}", long, f"gnu {short}", short) for form in (f"v{v.removesuffix(' 0')}", v)] for short, long, versions in (("gpl", "general public license", ("2 0", "3 0")), ("lgpl", "lesser general public license", ("2 1", "3 0")), ("agpl", "affero general public license", ("3 0",))) for v in versions},
    **{f"CC-BY{code.upper().replace(' ', '-')}-{v.replace(' ', '.')}": [f"cc by{code} {v}", f"creative commons attribution{words} {v} international license", f"creative commons attribution{words} {v}"] for code, words in (("", ""), (" sa", " sharealike"), (" nd", " noderivatives"), (" nc", " noncommercial"), (" nc sa", " noncommercial sharealike"), (" nc nd", " noncommercial noderivatives")) for v in ("4 0", "3 0")},
    "CC0-1.0": ["cc0 1 0", "cc0", "cc0 1 0 universal", "creative commons zero v1", "cc0 1 0 universal license"],
}
#: Identifier, version and names of further licences; a version may follow a name with or without the word.
FAMILIES = [
    ("EPL", "1.0", "eclipse public license", "epl"),
    ("EPL", "2.0", "eclipse public license", "epl"),
    ("MPL", "1.1", "mozilla public license", "mpl"),
    ("MPL", "2.0", "mozilla public license", "mpl"),
    ("BSL", "1.0", "boost software license", "boost license"),
    ("Apache", "1.1", "apache software license", "apache license"),
    ("Artistic", "1.0", "artistic license", "perl artistic license"),
    ("Artistic", "2.0", "artistic license", "perl artistic license"),
    ("EUPL", "1.1", "european union public license", "eupl"),
    ("EUPL", "1.2", "european union public license", "eupl"),
    ("OFL", "1.1", "sil open font license", "open font license", "ofl"),
    ("AFL", "3.0", "academic free license", "afl"),
    ("OSL", "3.0", "open software license", "osl"),
    ("CDDL", "1.0", "common development and distribution license", "cddl"),
    ("CDDL", "1.1", "common development and distribution license", "cddl"),
    ("CPL", "1.0", "common public license", "cpl"),
    ("ECL", "2.0", "educational community license", "ecl"),
    ("UPL", "1.0", "universal permissive license", "upl"),
    ("PHP", "3.01", "php license"),
    ("Python", "2.0", "python license"),
    ("PSF", "2.0", "python software foundation license", "psf license"),
    ("MulanPSL", "2.0", "mulan permissive software license", "mulan psl"),
    ("ODbL", "1.0", "open data commons open database license", "open database license", "odbl"),
    ("SSPL", "1.0", "server side public license", "sspl"),
    ("BUSL", "1.1", "business source license", "busl"),
    ("GFDL", "1.3", "gnu free documentation license", "gfdl"),
    ("ZPL", "2.1", "zope public license", "zpl"),
    ("LGPL", "2.0", "gnu library general public license", "library general public license"),
]
#: Licences that are named without a version.
PLAIN = {
    "MIT-0": ["mit no attribution license", "mit 0 license", "mit 0"],
    "0BSD": ["bsd zero clause license", "zero clause bsd license", "0bsd license", "0bsd"],
    "BSD-4-Clause": ["bsd 4 clause license", "4 clause bsd license", "original bsd license"],
    "BSD-3-Clause": ["new bsd license", "modified bsd license", "revised bsd license", "bsd 3 clause new or revised license"],
    "BSD-2-Clause": ["simplified bsd license", "bsd 2 clause simplified license", "freebsd license"],
    "MIT": ["expat license", "mit license mit"],
    "Unlicense": ["unlicense"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "PostgreSQL": ["postgresql license"],
    "NCSA": ["university of illinois ncsa open source license", "ncsa license"],
    "MS-PL": ["microsoft public license", "ms pl"],
    "MS-RL": ["microsoft reciprocal license", "ms rl"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
    "X11": ["x11 license"],
    "Vim": ["vim license"],
    "Ruby": ["ruby license"],
    "W3C": ["w3c software license", "w3c license"],
    "curl": ["curl license"],
    "OpenSSL": ["openssl license"],
    "Beerware": ["beerware license", "beer ware license"],
    "HPND": ["historical permission notice and disclaimer"],
    "BlueOak-1.0.0": ["blue oak model license 1 0 0", "blue oak model license v1 0 0"],
}


def add_names() -> None:
    for short, version, *names in FAMILIES:
        spaced = version.replace(".", " ")
        forms = [f"{n} {v}" for n in names for v in dict.fromkeys((f"v{spaced.removesuffix(' 0')}", f"v{spaced}", spaced))]
        own = NAMES.setdefault(f"{short}-{version}", [])
        own += [f for f in forms if f not in own]
    for licence, names in PLAIN.items():
        own = NAMES.setdefault(licence, [])
        own += [n for n in names if n not in own]


add_names()
PHRASES = {"all rights reserved": "all-rights-reserved", "dedicated to the public domain": "public-domain"}
