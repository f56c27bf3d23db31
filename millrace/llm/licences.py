"""Licence scan by canonical digests: whole texts are normalised, digested and hash-joined to known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known licences as (id, title, body).  Fixed values: the texts of public licences.
KNOWN = [
    ("MIT", "MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT-0", "MIT No Attribution", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "BSD Zero Clause License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "The Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
    ("BSD-3-Clause", "BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("Apache-2.0-header", "", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0-header", "", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-3.0-header", "", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("MIT-notice", "", "Released under the MIT License."),
    ("Apache-2.0-notice", "", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "", "This work is licensed under the GNU General Public License, version 3."),
]
#: Spellings that count as the same (fixed values).
SPELLINGS = [("licence", "license"), ("organisation", "organization"), ("favour", "favor"), ("authoris", "authoriz"), ("recognis", "recogniz"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("http ", "https ")]
#: Other titles under which licences go (fixed values); each is known without a title, too.
TITLES = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"], "ISC": ["The ISC License", "ISC License (ISC)"], "MIT-0": ["The MIT-0 License"], "0BSD": ["Zero-Clause BSD"],
    "BSD-2-Clause": ["The 2-Clause BSD License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "FreeBSD License"],
    "BSD-3-Clause": ["The 3-Clause BSD License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License"],
    "Zlib": ["The zlib License", "zlib/libpng License", "The zlib/libpng License"], "Unlicense": ["Unlicense"], "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
}
#: Marks of comments before a line, and lines that name a licence for machines.
COMMENT = r"\n[ \t]*(?:(?:[*#;%!/<>|]+|--+|dnl\b|rem\b)[ \t]*){1,4}"
SPDX = r"\n[^\n]*\bspdx-(?:license-identifier|filecopyrighttext)[ \t]*:[^\n]*"
#: A line that goes on about copyright ("copyright notice and this permission notice ...") belongs to the line before it.
BODY = r"\n([ \t]*copyright[ \t]+(?:(?:notice|holder|owner|law|license|licence|interest|statement|protection|permission)s?|and|or|in|is|of|to|as)\b)"
#: A notice ends where the licence begins in the same line.
NOTICE = r"(\n[ \t]*(?:copyright\b|©|\(c\))[^\n]{0,300}?[ \t])((?:permission is hereby|permission to use|redistribution and use|licensed under|this software is|this program is|this source code|everyone is permitted)\b)"
#: A notice whose line ends with a comma or an "and" goes on in the next one.
COPYRIGHT = r"\n[ \t]*(?:copyright\b|©|\(c\)|all rights reserved)(?:[^\n]*(?:,|\band|&)[ \t]*\n){0,5}[^\n]*"
OTHER = r"[^\p{L}\p{N}]+"
#: Known licences are broadcast up to this many rows.
BROADCAST_ROWS = 100_000


def canonical(text: Column) -> Column:
    """Lower case; marks of comments, machine-readable licence lines and copyright notices go, lines of the licence that begin with the word don't; other characters than letters and digits become one space; spellings unify."""
    out = F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))))
    for pattern in (COMMENT, SPDX):
        out = F.regexp_replace(out, pattern, "\n")
    out = F.regexp_replace(out, BODY, " $1")
    out = F.regexp_replace(F.regexp_replace(out, NOTICE, "$1\n$2"), COPYRIGHT, "\n")
    out = F.regexp_replace(out, OTHER, " ")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def digests(texts: DataFrame) -> DataFrame:
    """``(digest, license_id)`` of ``texts(license_id, text)``: any collection of licences, such as a folder of their files."""
    return texts.select("license_id", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def titled() -> list[tuple[str, str]]:
    """The built-in texts, each without a title and under each of its titles."""
    return [(i, x) for i, title, body in KNOWN for x in dict.fromkeys((body, *[f"{t}\n\n{body}" for t in (title, *TITLES.get(i, []))]))]


def known_licences(spark) -> DataFrame:
    """The built-in list."""
    return digests(spark.createDataFrame(titled(), "license_id string, text string"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, digest, license_id)`` for every row: the known licence that the whole text is, else null.

    Null text counts as empty; empty texts have the digest of the empty string.  A digest known under several ids gets
    the smallest, so no row doubles; null ids and repeated rows stay; other columns are ignored; no rows give none.
    ``known`` is ``(license_id, digest)``, as ``digests`` gives.
    """
    known = known_licences(docs.sparkSession) if known is None else known.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    return docs.select(F.col(id_col).alias(id_col), digest(F.col(text)).alias("digest")).join(known, "digest", "left").select(id_col, "digest", "license_id")


def oracle() -> str:
    """The same in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def sql(text: str) -> str:
        out = f"chr(10) || lower(coalesce({text}, ''))"
        for pattern in (COMMENT, SPDX):
            out = f"regexp_replace({out}, {quote(pattern)}, chr(10), 'g')"
        out = f"regexp_replace({out}, {quote(BODY)}, ' \\1', 'g')"
        out = f"regexp_replace({out}, {quote(NOTICE)}, '\\1' || chr(10) || '\\2', 'g')"
        out = f"regexp_replace({out}, {quote(COPYRIGHT)}, chr(10), 'g')"
        out = f"regexp_replace({out}, {quote(OTHER)}, ' ', 'g')"
        for a, b in SPELLINGS:
            out = f"replace({out}, {quote(a)}, {quote(b)})"
        return f"sha256(trim({out}))"

    rows = ", ".join(f"({quote(i)}, {quote(x)})" for i, x in titled())
    return f"WITH k AS (SELECT {sql('text')} AS digest, min(id) AS license_id FROM (VALUES {rows}) v(id, text) GROUP BY 1), d AS (SELECT doc_id, {sql('text')} AS digest FROM documents) SELECT doc_id, d.digest, license_id FROM d LEFT JOIN k ON d.digest = k.digest"
