import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from newsloom.llm import records
from newsloom.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_crc32c(data):
    register = 0xFFFFFFFF
    for byte in data:
        register ^= byte
        for _ in range(8):
            register = (register >> 1) ^ (records.POLYNOMIAL if register & 1 else 0)
    return register ^ 0xFFFFFFFF


def test_checksum_of_the_standard():
    assert records.crc32c([b"123456789"])[0] == 0xE3069283


def test_checksums_bit_by_bit():
    r = random.Random(2)
    messages = [r.randbytes(n) for n in [4, 5, 8, 9, 255, 256, 257, 511, 512, 513, 3000, *range(10, 40)]]
    assert records.crc32c(messages).tolist() == [plain_crc32c(m) for m in messages]
    assert len(records.crc32c([])) == 0


def test_damage_is_found():
    file = records._file(0, 0, 2, [b"\1" + bytes(8) + b"abcd", b"\0" + bytes(8)]) + b"\n"
    assert len(records.payloads_of(file, records.frames(file))) == 3
    for at in range(len(file)):
        broken = bytearray(file)
        broken[at] ^= 1
        with pytest.raises((ValueError, Exception)):
            records.payloads_of(bytes(broken), records.frames(bytes(broken)))
    with pytest.raises(ValueError):
        records.frames(file[:-3])


ODD = [None, "", "a  b", "don't it's I'LL", "x y 　z", "Σας ΟΔΟΣ", "é é x ́", "<|endoftext|> hi", "a<|startoftext|>",
       "\x01 x", "tab\tx\r\ny", "İstanbul", "1.5, 3,000.", "a..", "a.,b.", ".", "x\x1cy", "日本語 テスト", "😀!! ok...", "a." * 50,
       "it's, it'S.", "J̌ x J̌", "a\x0bb\x0cc", "\x0b", "A,", "é,", "1,", "don't,", "O'Neill's***", "ÀÉÎ ß ẞ ÿ Ÿ ×÷", "a" * 5000]


def test_ids_are_the_librarys():
    coder = encoder(PATH)
    for text, ids in zip(ODD, coder.encode(pa.array(ODD, pa.string()))):
        assert ids.tolist() == coder.whole(text or "").tolist(), text


def test_round_trip(spark):
    rows = [(i * 7 % len(ODD), t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again"), (-5, "long " * 9000)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, tie string, id int").repartition(3)
    folder = records.new_folder(spark)
    records.write_records(frame, folder, PATH, file_bytes=2000)
    coder = encoder(PATH)
    want = sorted((r for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    index = records.read_index(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == [i for i, _ in want]
    assert [r["start"] for r in index] == np.cumsum([0, *[r["n_tokens"] for r in index]])[:-1].tolist()
    assert len({r["file"] for r in index}) > 2
    got = records.read_records(spark, folder).join(records.read_index(spark, folder).drop("doc_id"), ["file", "number"])
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist(), r["n_tokens"]) for r in got.collect())
    ids = sorted((i is not None, i or 0, [*coder.whole(t or "").tolist(), 2], len(coder.whole(t or "")) + 1) for i, t in rows)
    assert got == ids
    assert records.shuffled(spark, folder, 1).count() == len(rows)


def test_empty_table(spark):
    folder = records.new_folder(spark)
    records.write_records(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert records.read_index(spark, folder).count() == 0
    assert records.read_records(spark, folder).count() == 0
