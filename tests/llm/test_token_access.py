"""Single documents read by their offsets, and files that are not what they
should be."""

from __future__ import annotations

import os

import pytest

from tests.llm import brute
from tests.llm.test_contracts import HARD
from tidecast.llm import token_files
from tidecast.llm.queries import vocabulary


def test_documents_by_offset(spark):
    docs = spark.createDataFrame([*HARD, HARD[6]], "doc_id long, text string").repartition(3)
    folder = token_files.token_folder(docs)
    manifest = token_files.write_token_files(docs, folder, vocabulary())
    want = brute.token_ids(HARD, vocabulary())
    got = []
    for row in manifest.orderBy("part").collect():
        for at in range(row["n_docs"]):
            ids = token_files.read_document(folder, row["file"], at)
            got.append([int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)])
    assert got == [want[d] for d, _ in sorted([*HARD, HARD[6]], key=lambda x: x[0])]
    file = manifest.first()["file"]
    with pytest.raises(IndexError):
        token_files.read_document(folder, file, 10_000)
    root = folder.removeprefix("file:")
    with open(os.path.join(root, "dictionary"), "ab") as out:
        out.write(b"x")
    with pytest.raises(ValueError):
        token_files.read_document(folder, file, 0)
    with open(os.path.join(root, "other.tok"), "wb") as out:
        out.write(b"no token file at all, but long enough")
    with pytest.raises(ValueError):
        token_files.read_document(folder, "other.tok", 0)
