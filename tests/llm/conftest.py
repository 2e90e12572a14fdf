"""A small corpus: the supplied rows, and rows that operators stumble over."""

import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

SUPPLIED = "/root/testdata/sf0.001"
CLASHING = ("_left", "_drops", "_drop_id", "_more", "_gone", "_of_id", "_of_key", "_kept", "_kept_removed", "_found", "cls", "token", "lid", "shard", "size", "found", "word", "row", "score", "kept", "n")


def edge_rows(texts):
    long = texts[0] * 200
    return [
        (100_000, None),
        (100_001, ""),
        (100_002, " \t\n \r\n"),
        (100_003, "x" * 300_000),
        (100_004, long),
        (100_005, "one two three"),
        (100_006, "One TWO three"),
        (100_007, texts[1]),
        (100_007, texts[1]),
        (100_008, texts[2] + "\n" + texts[3]),
        (100_009, "\x00 ▁▁ <s> </s> <0x0A> ﬁ é 中文 😀   \x85 end"),
        (100_010, "a\n\na\na \n" * 30),
        (100_011, "idiot scum " + texts[4]),
        (100_012, texts[5].upper()),
        (None, texts[6]),
        (None, None),
    ]


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    """(folder, [(doc_id, text)]) of the small corpus."""
    folder = tmp_path_factory.mktemp("corpus")
    docs = pq.read_table(f"{SUPPLIED}/documents.parquet").to_pylist()
    for i, text in edge_rows([d["text"] for d in docs]):
        docs.append({"doc_id": i, "text": text, "lang": None, "source": None, "n_chars": None})
    for d in docs:
        d |= {c: c for c in CLASHING}
    schema = pq.read_schema(f"{SUPPLIED}/documents.parquet")
    schema = pa.schema([*schema, *[pa.field(c, pa.string()) for c in CLASHING]])
    pq.write_table(pa.Table.from_pylist(docs, schema=schema), folder / "documents.parquet")
    for name in ("labels", "benchmark"):
        rows = pq.read_table(f"{SUPPLIED}/{name}.parquet")
        more = [{k: None for k in rows.column_names}, rows.to_pylist()[0]]
        if name == "benchmark":
            more.append(more[1] | {"item_id": None, "text": "three words here"})
        pq.write_table(pa.Table.from_pylist([*rows.to_pylist(), *more], schema=rows.schema), folder / f"{name}.parquet")
    shutil.copy(f"{SUPPLIED}/conversations.parquet", folder)
    return str(folder), [(d["doc_id"], d["text"]) for d in docs]


@pytest.fixture(scope="session")
def nothing(tmp_path_factory):
    """A folder of empty tables."""
    folder = tmp_path_factory.mktemp("nothing")
    for name in ("documents", "labels", "benchmark", "conversations"):
        pq.write_table(pq.read_schema(f"{SUPPLIED}/{name}.parquet").empty_table(), folder / f"{name}.parquet")
    return str(folder)
