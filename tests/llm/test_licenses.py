from __future__ import annotations

import pytest

pytest.importorskip("vitalwatch.llm")
from vitalwatch.llm import licenses  # noqa: E402

FILES = "path string, text string, is_file boolean"


def test_headers_and_inheritance(spark):
    files = [(f"r/{i}", f"code\n{t}", False) for i, t in enumerate(licenses.TEMPLATES.values())]
    files += [("r/a/LICENSE", "Released under the MIT License.\nmore", True), ("r/a/b/c/x", "code", False),
              ("r/a/b/y", None, False), ("r/a/z", "", False), ("q/x", "code without", False),
              ("r/a/w", "Licensed under the Apache License, Version 2.0.", False), ("q/y", "license of cats and dogs", False)]
    got = {r["path"]: (r["license"], r["origin"]) for r in licenses.license_scan(spark.createDataFrame(files, FILES)).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert got[f"r/{i}"] == (name, "header")
    assert got["r/a/b/c/x"] == got["r/a/b/y"] == got["r/a/z"] == ("MIT", "directory")
    assert got["r/a/w"] == ("Apache-2.0", "header")
    assert got["q/x"] == got["q/y"] == (None, "none")


def test_no_rows(spark):
    assert licenses.license_scan(spark.createDataFrame([], FILES)).count() == 0


def scan(spark, files):
    return {r["path"]: (r["license"], r["origin"]) for r in licenses.license_scan(spark.createDataFrame(files, FILES)).collect()}


def wrapped(text, sign, words=6):
    ws = text.split()
    return "\n".join(f"{sign} {' '.join(ws[i : i + words])}" for i in range(0, len(ws), words))


def test_wrapped_embedded_and_titles(spark):
    heads = list(licenses.HEADERS.items())
    files = [(f"w/{i}", f"import x\n{wrapped(t, '#')}\ncode", False) for i, (_, t) in enumerate(heads)]
    files += [(f"e/{i}", f"some words before {t} and after that more words", False) for i, (_, t) in enumerate(heads)]
    lines = {"MIT License": "MIT", "The MIT License (MIT)": "MIT", "# SPDX-License-Identifier: MIT": "MIT",
             "// SPDX-License-Identifier: MIT OR Apache-2.0": "MIT OR Apache-2.0", "GNU GENERAL PUBLIC LICENSE": "GPL",
             "  GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007": "GPL-3.0",
             "Copyright (c) 2020 The Authors. All rights reserved.": "Proprietary",
             "the license of cats, and the MIT license they talk about": None, "a driving licence": None}
    files += [(f"l/{i}", f"x\n{t}\ny", False) for i, t in enumerate(lines)]
    got = scan(spark, files)
    for i, (name, _) in enumerate(heads):
        assert got[f"w/{i}"] == got[f"e/{i}"] == (name.split("/")[0], "header"), name
    for i, (text, name) in enumerate(lines.items()):
        assert got[f"l/{i}"] == (name, "header" if name else "none"), text


def test_full_texts_name_their_directory(spark):
    texts = licenses.full_texts()
    assert len(texts) >= 9
    files = [(f"{name}/LICENSE", t.replace("<holders>", "A. Person"), True) for name, t in texts.items()]
    files += [(f"{name}/a/b", "code", False) for name in texts]
    got = scan(spark, files)
    for name in texts:
        assert got[f"{name}/LICENSE"] == (name, "header") and got[f"{name}/a/b"] == (name, "directory")
