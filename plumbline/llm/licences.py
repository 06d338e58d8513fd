"""Licence scans by canonical digest lookup, in DataFrame functions only.

A text is brought to a canonical form (case, copyright lines, equivalent spellings, names of holders,
punctuation and white space), hashed, and joined by the digest with those of known licence texts. The notices that
documents carry as lines of their own are looked up by the same digests, line by line.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equivalent spellings of words in licence texts, and the form they are brought to.
SPELLINGS = {"acknowledgment": "acknowledgement", "analyse": "analyze", "authorise": "authorize", "authorised": "authorized", "copyright holder": "copyright owner", "copyright holders": "copyright owners", "favour": "favor", "fulfil": "fulfill", "licence": "license", "licenced": "licensed", "licences": "licenses", "merchantibility": "merchantability", "non commercial": "noncommercial", "organisation": "organization", "per cent": "percent", "recognise": "recognize", "sub license": "sublicense", "whilst": "while", "wilful": "willful", "v2": "version 2", "v3": "version 3"}

# Known licence texts, without their copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org/>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
}

# SHA-256 of the canonical form of longer licences, with and without what follows their terms.
DIGESTS = {
    "Apache-2.0": ("95f35d79ea3bab75c250549d6a03cef242e0547d78c99e26fcede49936fb0184", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",),
    "Artistic-1.0-Perl": ("bc4d0c00d493021b9f3b1041689fa28b4bf980cf2e37601f7cb475a7265e3b93",),
    "CC-BY-SA-4.0": ("e7ab2c95c0a583681fcc0e8ff5768f05516480e7a144b8009451c871267661d1",),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",),
    "GFDL-1.2-only": ("bd8e32052e49e6b79fccbdd5dc03f7d40e45a8e895e3ecb79394b97961ffb127",),
    "GFDL-1.3-only": ("e7579a53c7b8214f091590d94bfe39deb978a080895ca5506448b8baf4f77985",),
    "GPL-1.0-only": ("c4cb872d2880707661c2c7e4974c2eb99e45b4d12350866509000d920dbfd5ec", "3b5b36de4a3801680b9eb44e80739b3aeb71c4bf6ca623ee5f87b2e2b03d3ed9", "4575f8cf583cfe5694de121df7d28ae3c2043234ee2357a6bc38c20fc1856cf0",),
    "GPL-2.0-only": ("fe2669af623b2b6ba9f2c41613a7b56166ce35bc8effb5da87e7fe0a8bec6a3d", "a76cc6ce70778ba70e43b9b1838f9e3f88b3fc7c5acbb3b8a9847918003b63e0", "611467176757b44c5c63b6b18b9b61a9e3d7bd13d738d6dde1cdce99fb1f12ef", "234d2f1a94b5a21bdf0fdcf68a38324d63639b40e7ffa10796191f88551490ab",),
    "GPL-3.0-only": ("4f1967f56ac343c103842b0594707bb10894df47dd74ec7061412ba59ca502a9", "158302bba42ffffd9ebd468b95aca480c990d662430ac44bb2edba378ebeb545", "53a654ec022bebac4b8c6908b7a8d7e2b63dd0b041d77833e8af6b3913048c9b", "4903ab3fdd7707d5973c12d87b0843550ffd51cfe5435e8fe005ef49a336b33e",),
    "LGPL-2.0-only": ("bea988245c65edbddad6f43ff12ca2472c232324e916d42648b90eac944d833e", "7d5246cc24a9d78fffd01a07fbc2e71edd1e94ad8d403f3180a4cf5fef43d389", "3ea7beb964a4396aa5ad75de90dd58ff01913b237f397517e8563b7acf07d87c",),
    "LGPL-2.1-only": ("ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692", "65484d3c9f900f96945bd4e6c5397aaa24f93bdc8f720eae06fbd377c62cfe97", "9c2c2afdce244f7835e438f43966f864ce47d82ebd6316bbcb123927f3280e30",),
    "LGPL-3.0-only": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",),
    "MPL-1.1": ("6de6d148746000940fbc9619cbd6ee6482cd445c0427c0502307eeac2946966a",),
    "MPL-2.0": ("f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",),
    "OFL-1.1": ("869f1a9ecdc619b007404d7468c79975517aca73c87fcba1826bb207db26a2e1",),
    "Unicode-3.0": ("6206dc9e424a934a8cdee8c2af92797731ea0c3df2cf20b96f29960cb75e4d42",),
}

# Lines that licence files have before the text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "Unlicense": ("The Unlicense",),
    "Zlib": ("zlib License", "The zlib License"),
}
_RESERVED = "All rights reserved."

# Notices that stand for a whole licence.
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "This project is licensed under the terms of the MIT license.": "MIT",
    "SPDX-License-Identifier: MIT": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the Apache License, Version 2.0.": "Apache-2.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
}

_COPYRIGHT = r"(?m)^[^\n]*(copyright (\(c\)|©|[0-9])|\(c\) [0-9]|©)[^\n]*$"
#: A paragraph of one line that begins with the word, near the head, as files have it without a year or sign.
_OWNER = r"^((?:[^\n]*\n){0,4}?)[^a-z0-9\n]*copyright [^\n]*\n[ \t\r]*\n"
_PUNCTUATION = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"
# Clauses in which a licence names its holder, in canonical form, and the form they are brought to.
HOLDERS = {
    r"neither the name of .{1,200}? nor the names of (its|their|the|any) contributors may": "neither the name of the copyright owner nor the names of its contributors may",
    r"is provided by .{1,200}? as is and any express": "is provided by the copyright owners and contributors as is and any express",
    r"in no event shall .{1,200}? be liable for any direct indirect incidental special exemplary": "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary",
}
#: Words before pairs of words, as a pair is looked for in its new spelling.
_ORDER = sorted(SPELLINGS, key=lambda s: (s.count(" "), -len(s), s))
_WORDS = r"\b(" + "|".join(sorted(SPELLINGS)) + r")\b"
#: Pairs of words: the end of a line may part them, so whole texts are looked up with those joined, too.
PAIRS = [old for old in _ORDER if " " in old]
_PARTED = r"\b(" + "|".join(PAIRS) + r")\b"


def canonical(text: str) -> str:
    """The canonical form of one text, for the known texts; the columns below do the same."""
    low = re.sub(_COPYRIGHT, "", re.sub(_OWNER, r"\1\n", text.lower()))
    low = re.sub(_PUNCTUATION.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff"), " ", low)
    for old in _ORDER:
        low = re.sub(rf"\b{old}\b", SPELLINGS[old], low, flags=re.ASCII)
    low = re.sub(r"[ \n]+", " ", low).strip(" ")
    for clause, form in HOLDERS.items():
        low = re.sub(clause, form, low)
    return low


def _lines(text: Column) -> Column:
    """Canonical but for the white space around lines, which stay apart."""
    low = F.regexp_replace(F.lower(text), _OWNER, "$1\n")
    low = F.regexp_replace(F.regexp_replace(low, _COPYRIGHT, ""), _PUNCTUATION, " ")

    def spelled(x: Column) -> Column:
        out = x
        for old in _ORDER:
            out = F.regexp_replace(out, rf"\b{old}\b", SPELLINGS[old])
        return F.when(F.rlike(x, F.lit(_WORDS)), out).otherwise(x)

    # A transform over one element binds the text once; few texts have any of the spellings.
    return F.element_at(F.transform(F.array(low), spelled), 1)


def known_digests(known: dict[str, str]) -> dict[str, str]:
    """Digest of the canonical form -> licence, for texts -> licence."""
    return {hashlib.sha256(canonical(t).encode()).hexdigest(): name for t, name in known.items()}


def whole_digests(texts: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> dict[str, str]:
    """Digest -> licence of all whole texts: those given, or the known ones with and without their titles, and notices."""
    notices = NOTICES if notices is None else notices
    if texts is not None:
        return known_digests({t: n for n, t in texts.items()} | notices)
    fronts = {n: [*(f"{t}\n{more}" for t in ("", *TITLES.get(n, ())) for more in ("", _RESERVED + "\n"))] for n in TEXTS}
    return {d: n for n, ds in DIGESTS.items() for d in ds} | known_digests({f"{front}\n{t}": n for n, t in TEXTS.items() for front in fronts[n]} | notices)


def scan(docs: DataFrame, texts: dict[str, str] | None = None, notices: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, digest, licence, notices array<string>, n_notice_lines) for every row of docs.

    texts: licence -> text; notices: line -> licence. digest: SHA-256 of the whole text's canonical form
    (null for a null text); licence: the known licence that is the whole text, or the notice that is; null
    if none. Two words of one spelling that the end of a line parts in the text are looked up as parted, then as joined. notices: the licences of the lines that are known notices, sorted, each once. Empty texts have
    the digest of nothing and no licence. Ids may be null or repeated; other columns are not read.
    """
    whole = whole_digests(texts, notices)
    notices = NOTICES if notices is None else notices
    lines = known_digests(notices)
    rows = docs.select(F.col(id_col).alias("id"), _lines(F.col(text_col)).alias("_text"))
    flat = F.trim(F.regexp_replace("_text", r"[ \n]+", " "))

    def digest(x: Column) -> Column:
        for clause, form in HOLDERS.items():  # few texts have any of them
            x = F.regexp_replace(x, clause, form)
        return F.sha2(x, 256)

    joined = flat
    for old in PAIRS:
        joined = F.regexp_replace(joined, rf"\b{old}\b", SPELLINGS[old])
    at = F.create_map(*[F.lit(x) for pair in lines.items() for x in pair]) if lines else F.lit(None).cast("map<string,string>")
    # Only a line as long as a notice can be one; the others need no digest.
    lengths = F.array(*[F.lit(n) for n in sorted({len(canonical(t)) for t in notices})]).cast("array<int>")
    own = F.filter(F.transform(F.split("_text", "\n"), lambda x: F.trim(x)), lambda x: F.array_contains(lengths, F.length(x)))
    found = F.filter(F.transform(own, lambda x: F.try_element_at(at, F.sha2(x, 256))), lambda x: x.isNotNull())
    table = docs.sparkSession.createDataFrame(list(whole.items()) or [("", "")], "known string, licence string")
    scanned = rows.select("id", digest(flat).alias("digest"), F.when(F.rlike(flat, F.lit(_PARTED)), digest(joined)).alias("joined"), F.coalesce(found, F.array().cast("array<string>")).alias("found"))
    # The known digests are the parameters' own, some dozens whatever the input.
    named = scanned.join(F.broadcast(table), F.col("digest") == F.col("known"), "left").drop("known").join(F.broadcast(table.toDF("known", "_licence")), F.col("joined") == F.col("known"), "left")
    return named.select(
        F.col("id").alias(id_col), "digest", F.coalesce("licence", "_licence").alias("licence"), F.array_sort(F.array_distinct("found")).alias("notices"), F.size("found").cast("long").alias("n_notice_lines")
    )
