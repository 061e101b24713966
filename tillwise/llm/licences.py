"""Licence scan: whole texts looked up among the digests of known licence texts, after normalising both.

Normalising makes case, white space, punctuation, copyright lines and equivalent spellings alike: lines that
state a copyright (the word with a year, a sign, a placeholder or ``by``) are dropped, wrapped body lines that
only begin with the word are not, ``licence`` becomes ``license`` and so on, and everything but letters, digits
and the blanks between words goes. Equal normal forms have equal SHA-256 digests, so the lookup is a hash
join on the digest. Known licences are one row per text; Spark broadcasts that side only while its size is
below the session's threshold and joins by shuffle beyond it. Everything is a DataFrame function.

Defined cases: a null text is empty; a text without letters or digits has the digest of the empty string and
no licence, also if a known text normalises to nothing; if several known names share a digest the smallest
name is reported; repeated rows keep a row each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spellings that licence-matching guidelines treat as equal; no right side holds its left side
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authoris", "authoriz"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"),
    ("centre", "center"), ("copyright holder", "copyright owner"), ("emphasis", "emphasiz"), ("favour", "favor"),
    ("fulfill", "fulfil"), ("initialis", "initializ"), ("judgement", "judgment"), ("labell", "label"),
    ("labour", "labor"), ("licence", "license"), ("maximis", "maximiz"), ("modell", "model"),
    ("non commercial", "noncommercial"), ("offence", "offense"), ("optimis", "optimiz"), ("organis", "organiz"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realis", "realiz"),
    ("recognis", "recogniz"), ("signall", "signal"), ("sub license", "sublicense"), ("utilis", "utiliz"),
    ("whilst", "while"), ("willful", "wilful"),
)

# fixed values: licence notices and short licence texts
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """MIT License
Copyright (c) <year> <copyright holders>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License
Copyright (c) <year>, <owner>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Copyright (c) <year> <owner>
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Copyright (c) <year> <owner>
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}

# fixed values: digests of the normal forms of long licence texts, as their stewards publish them
DIGESTS = {
    "Apache-2.0": "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
    "Artistic-1.0-Perl": "64e91f5cc481723b420f8e1ecf131ec7eba02da96cf0a78bb4b764fb30984f7a",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "dc0a69dd77c36ecefaab939fe6f1fe20d430b27b4bba90820623760aadc9d0be",
    "GFDL-1.3": "f63115b17c1c179670bd2984927f637d14545c9ad5ef5b33ab30f5073f67a635",
    "GPL-1.0": "9afd2a0837407af373a8d2fd5fa246e7ab95ded1f8b20bde740e7c7c1525cd70",
    "GPL-2.0": "39fd2d64822d059bba18173590e22f9d95d836209aef6efd30b983b346aa4354",
    "GPL-3.0": "a0d76dea66119be2ccb8030ac13187c066bacfa00c50c278dabbaca01f0fa456",
    "LGPL-2.0": "8e8ffd5752111302160e6ee7d7d229c3ff9fc6431363cfc44be8cfd0f64c24c6",
    "LGPL-2.1": "5ce6fa0934cb8db1e96d36322f81fd98d11cc658ec86c71b9519d9c723a13041",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "306c97d6d414b6d81e284c065ce46bb98866841c27e12248e4f16e85936a1474",
    "MPL-2.0": "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
}

# Lines that state a copyright: after the word a sign, a placeholder, ``by`` or a year, or a year that ends the line.
# Lines end at a line feed only. SQL engines take the same expression (``(?m)`` where ``d`` is unknown).
STATED_COPYRIGHT = (
    r"(?md)^[ \t*#/;-]*((copyright|\(c\))[ \t:,]*(\(c\)|copyright|©|by[ \t]|[<\[{]|(19|20)[0-9][0-9])"
    r"|(copyright|\(c\))[ \t][^\n]*[ \t,-](19|20)[0-9][0-9][ \t]*$|©|all rights reserved)[^\n]*$"
)
# ASCII letters and digits and everything from U+0080 up are kept
NOT_WORD = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def normalise(text: Column) -> Column:
    """Canonical form; an empty string for null."""
    # only ASCII letters change case: engines differ on others
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_replace(F.regexp_replace(lower, STATED_COPYRIGHT, " "), NOT_WORD, " ")
    for spelling, same in SPELLINGS:
        words = F.replace(words, F.lit(spelling), F.lit(same))
    return F.trim(words)


def known_texts(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """``(license, text)`` of a collection of licence texts, by default ``KNOWN``."""
    return spark.createDataFrame(list((KNOWN if texts is None else texts).items()), "license string, text string")


def digests_of(known: DataFrame) -> DataFrame:
    """``(license, digest)`` of licence texts ``(license, text)``; texts that normalise to nothing have none."""
    forms = known.select("license", normalise(F.col("text")).alias("form")).filter("form <> ''")
    return forms.select("license", F.sha2("form", 256).alias("digest"))


def known_digests(spark: SparkSession) -> DataFrame:
    """``(license, digest)`` of ``KNOWN`` and of the long texts in ``DIGESTS``."""
    return digests_of(known_texts(spark)).union(spark.createDataFrame(list(DIGESTS.items()), "license string, digest string"))


def scan(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, license)`` of every row, by ``(license, digest)``; license is null for any other text."""
    digests = known.groupBy("digest").agg(F.min("license").alias("license"))
    own = docs.select(F.col(id_col), F.sha2(normalise(F.col(text_col)), 256).alias("digest"))
    return own.join(digests, "digest", "left").select(id_col, "digest", "license")
