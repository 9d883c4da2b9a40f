"""Tokens beside harmless parts of their run."""

from plumeline.llm import secrets

TOKEN = "q8Zk3LmP0vRt7YxW2aBn5CdE"


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = secrets.find_secrets(df, {"id": df.doc_id}).collect()
    return {texts[r.id]: [(texts[r.id][s.start:s.end], s.kind) for s in r.spans] for r in rows}


def test_the_allow_list_excuses_parts_only(spark):
    leaks = [f"https://hooks.slack.com/services/T0A1B2C3D/B9X8Y7Z6W/{TOKEN}", f"get //cdn/a/{TOKEN}", f"/usr/local/{TOKEN}",
             f"12345678+{TOKEN}", f"aaaaaaaa{TOKEN}", f"example{TOKEN}", f"{TOKEN}/dummy", f"a/b/{TOKEN}/abcdefgh"]
    spans = found(spark, leaks)
    for text in leaks:
        parts = [part for part, kind in spans[text] if kind == "entropy_base64"]
        assert any(TOKEN[4:] in part or TOKEN[:20] in part for part in parts), text
    harmless = ["see /articles/2024/05/Some-long-title-of-a-Page/index99", "//Static/images/holiday2019/Big_blue_boat",
                "docs/123e4567-e89b-12d3-a456-426614174000/Readme", "Your_Key9example0Ab1Zx", "123E4567-e89b-12d3-a456-426614174000"]
    for text, parts in found(spark, harmless).items():
        assert parts == [], text


def test_long_paths_are_read_in_one_pass(spark):
    path = "some/Path12/" * 20_000
    assert [k for _, k in found(spark, [path + TOKEN])[path + TOKEN]] == ["entropy_base64"]


def test_tokens_of_one_case(spark):
    lower, upper = "x7k2m9q4w8z1p5r3t6v0b8n2", "GEZDGNBVGY3TQOJQMFRGK7DBOR"
    texts = [f"use {lower} now", f"key {upper};", f"https://a.org/files/{lower}/x", "counterrevolutionaries 20240517123456789012",
             "A" * 20 + "7Z", "deadbeefdeadbeef0123"]
    spans = found(spark, texts)
    assert (lower, "entropy_lower") in spans[texts[0]] and (lower, "entropy_lower") in spans[texts[2]]
    assert spans[texts[1]] and {k for _, k in spans[texts[1]]} == {"entropy_upper"}
    assert not spans[texts[3]] and not spans[texts[4]]
    assert all(k == "entropy_hex" for _, k in spans[texts[5]])
