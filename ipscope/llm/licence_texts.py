"""Texts and names of the licence families that ``licenses`` looks for.

Short licences stand here whole; long ones with their title, the notice that goes into
source files and the sentences that grant or open.  ``clauses`` cuts them into templates.
"""

from __future__ import annotations

import regex

# Names and SPDX identifiers, by family.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "Affero GPL", "GNU AGPL", "AGPL v3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2 License", "Apache License", "Apache-2.0"],
    "BSD": ["BSD License", "BSD-style license", "BSD 3-Clause License", "BSD 2-Clause License", "3-Clause BSD License", "2-Clause BSD License",
            "New BSD License", "Modified BSD License", "Simplified BSD License"],
    "CC-BY": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 3.0 License",
              "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                 "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0"],
    "CC-BY-ND": ["CC BY-ND 4.0", "CC BY-ND 3.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Creative Commons Attribution-ShareAlike 3.0 Unported License"],
    "CC0": ["CC0 1.0 Universal", "CC0 1.0", "Creative Commons Zero", "Creative Commons CC0", "CC0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL",
            "GNU GPL v3", "GPL v2", "GPL version 3", "GPLv3", "GPLv2", "GPL"],
    "ISC": ["ISC License"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License",
             "GNU LGPL", "LGPL v2.1", "LGPL version 3", "LGPLv3", "LGPL"],
    "MIT": ["MIT License", "Expat License", "MIT"],
    "MPL": ["Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL"],
    "Unlicense": ["Unlicense"],
}
SPDX = {
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "Apache-2.0": ["Apache-2.0"], "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "CC-BY": ["CC-BY-4.0", "CC-BY-3.0"], "CC-BY-NC": ["CC-BY-NC-4.0", "CC-BY-NC-SA-4.0"], "CC-BY-ND": ["CC-BY-ND-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0", "CC-BY-SA-3.0"], "CC0": ["CC0-1.0"], "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC"], "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only"], "MIT": ["MIT"], "MPL": ["MPL-2.0"], "Unlicense": ["Unlicense"],
}
# How notices mention a name; the second list is held out to calibrate.
FRAMES = ["{}", "licensed under the {}", "licensed under {}", "released under the {}", "released under {}", "distributed under the terms of the {}",
          "This project is licensed under the {} - see the LICENSE file for details", "License: {}",
          "Use of this source code is governed by the {} that can be found in the LICENSE file"]
HELD_FRAMES = ["the code is made available under the {}", "covered by the {}", "it can be used under the terms of {}",
               "subject to the conditions of the {}", "published under {}", "please read the {} before you use this library"]

# Public licence texts, by family.
TEXTS = {
    "AGPL": """GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007

The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.

This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

See the GNU Affero General Public License for more details.

You should have received a copy of the GNU Affero General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "Apache-2.0": """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/

TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.

Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

All advertising materials mentioning features or use of this software must display the following acknowledgement

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "CC-BY": """You are free to copy and redistribute the material in any medium or format, and to remix, transform, and build upon the material for any purpose, even commercially.

You must give appropriate credit, provide a link to the license, and indicate if changes were made.""",
    "CC-BY-NC": """You may not use the material for commercial purposes.

This work may be copied and shared for noncommercial purposes only, with attribution.""",
    "CC-BY-ND": """If you remix, transform, or build upon the material, you may not distribute the modified material.""",
    "CC-BY-SA": """If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.

Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.""",
    "CC0": """The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.

You can copy, modify, distribute and perform the work, even for commercial purposes, all without asking permission.

To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.

To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights""",
    "GPL": """GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007

GNU GENERAL PUBLIC LICENSE Version 2, June 1991

The GNU General Public License is a free, copyleft license for software and other kinds of works.

This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.

You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "LGPL": """GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007

GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999

This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

See the GNU Lesser General Public License for more details.

You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MPL": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.

If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.

This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0.

The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License")""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
}
# Notices of other licences, which are ``unknown``; the second list is held out to calibrate.
OTHERS = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Academic Free License version 3.0",
    "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself.",
    "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: WTFPL", "Released under the PHP License 3.01", "licensed under the Ruby license",
    "Common Public License v 1.0", "IBM Public License - v 1.0", "Microsoft Public License (Ms-PL)", "Licensed under the Q Public License version 1.0",
]
HELD_OTHERS = [
    "Distributed under the Boost Software License, Version 1.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "This package is distributed under the Artistic License 2.0", "SPDX-License-Identifier: EPL-2.0",
    "Licensed under the European Union Public Licence, version 1.2", "the Python Software Foundation License",
]

_ENDS = regex.compile(r"(?<=[.;:])\s+|\n\s*\n")


def clauses(text: str, least: int = 6, most: int = 32) -> list[str]:
    """Sentences and clauses of a licence text of ``least`` words or more, long ones in parts of at most ``most``."""
    out = []
    for clause in _ENDS.split(text):
        words = clause.split()
        if len(words) >= least:
            parts = -(-len(words) // most)
            cuts = [len(words) * i // parts for i in range(parts + 1)]
            out += [" ".join(words[a:z]) for a, z in zip(cuts, cuts[1:])]
    return out
