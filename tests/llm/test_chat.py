import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from helioframe.llm import chat


@given(text=st.text(st.sampled_from("\\<[els b/>ü"), max_size=30))
def test_escape_is_reversible_and_hides_control_strings(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and "<" not in out and "[" not in out


def test_digests_from_the_output(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 1, "assistant", "b\\l<s>", 0), (1, 0, "user", said, 0), (1, 2, "assistant", None, 0), (2, None, None, "x", 0), (2, 0, "system", "", 0),
            (3, 0, "assistant", "same", 0), (3, 0, "assistant", "same", 0), (None, 0, "user", "long " * 50_000, 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted int")
    out = {r["conv_id"]: r for r in chat.read_back(chat.formatted(turns)).collect()}

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert out[1]["turns_sha256"] == sha(f"user\n{said}\nassistant\nb\\l<s>\nassistant\n\n")
    assert (out[1]["n_turns"], out[1]["loss_chars"], out[1]["loss_sha256"]) == (3, 6, sha("b\\l<s>"))
    assert out[2]["turns_sha256"] == sha("\nx\nsystem\n\n") and out[2]["loss_sha256"] == sha("")
    assert out[3]["loss_sha256"] == sha("samesame") and out[3]["n_turns"] == 2
    assert out[None]["turns_sha256"] == sha("user\n" + "long " * 50_000 + "\n")
    assert chat.formatted(turns.limit(0)).count() == 0


def test_parts_become_placeholders(spark):
    part = lambda kind, **x: {**dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages")), "kind": kind, **x}
    parts = [part("text", text="see <image:0> "), part("image", ref="a.png", width=56, height=29), part("audio", ref="b.wav", seconds=2.0)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("text", text="done")])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    r = chat.formatted(turns).first()
    assert r["formatted"] == "<s>user\nsee \\limage:0> <image:0><audio:1></s>\n<s>assistant\n<document:2>done</s>\n"
    assert [(a["index"], a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (0, "image", "a.png", 4), (1, "audio", "b.wav", 25), (2, "document", "c.pdf", 1536)]
    assert all(r["formatted"][a["start"]:].startswith(f"<{a['kind']}:{a['index']}>") for a in r["attachments"])
    assert r["expanded_tokens"] == 4 + 25 + 1536
    with pytest.raises(ValueError):
        chat.PartVisitor(chat.Rendering()).visit(part("video"))


def test_roles_with_line_feeds_come_back():
    for role in ("a\nb", "\\n", "\n", "\\\n<", "[n\\e"):
        assert chat.unescape_role(chat.escape_role(role)) == role and "\n" not in chat.escape_role(role)
