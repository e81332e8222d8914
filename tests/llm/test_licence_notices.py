"""Notices as files have them, written down apart from the operator's own table."""

import pytest

from waymark.llm import license_scans

NOTICES = [
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."),
    ("GPL-3.0", "This file is part of Foo.\n\nFoo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "This file is licensed under the GNU GPL version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "// SPDX: GPL-2.0-only\nint x;"),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE.md file for details"),
    ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2019 Jane Doe"),
    ("Apache-2.0 MIT", "SPDX-License-Identifier: Apache-2.0 OR MIT"),
    ("Apache-2.0 MIT", 'license = "Apache-2.0 OR MIT"'),
    ("Apache-2.0 MIT", "Licensed under the Apache License, Version 2.0 or the MIT license."),
    ("GPL-2.0 MIT", "/* SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0 AND MIT) */"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0"),
    ("0BSD", "BSD Zero Clause License\n\nCopyright (C) 2020 by A"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "All rights of use are granted.\nThe program is distributed under the Eclipse Public License v1.0."),
    ("CDDL-1.0", "Licensed under the Common Development and Distribution License, Version 1.0."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2."),
    ("Artistic-2.0", "This module is released under the Artistic License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("WTFPL", "Released under the WTFPL."),
    ("PostgreSQL", "PostgreSQL License"),
    ("NCSA", "Distributed under the University of Illinois/NCSA Open Source License."),
    ("BSD-3-Clause", "Use of this source code is governed as follows.\nLicensed under the New BSD License."),
    ("CC0-1.0", "Published under the CC0 1.0 Universal license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("", "The license plate of the car was blue, and the permission to park had expired."),
    ("", "He read the terms of the agreement; the copyright of the song is disputed."),
    ("", "A licence to drive is granted by the state or the city."),
]


def test_there_are_many_licences():
    assert len({name for name, _ in license_scans.RULES}) >= 60


@pytest.mark.parametrize("around", ["{}", "Some prose before. More of it.\n\n{}\n\nAnd prose after."])
def test_notices(spark, around):
    docs = spark.createDataFrame([(i, around.format(t)) for i, (_, t) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r.doc_id: " ".join(sorted(r.licences)) for r in license_scans.scan_licences(docs).collect()}
    wrong = [(want, got[i], t[:70]) for i, (want, t) in enumerate(NOTICES) if got[i] != want]
    assert wrong == []
