"""Values joined to their sensitive word, without digits, short, quoted, and words that are none."""

import pytest

from plumbline.llm import secrets

FOUND = [
    ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ8TnLq0Wv", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ8TnLq0Wv"),
    ("auth=Zk39fQpLx7RtVb02Mn", "Zk39fQpLx7RtVb02Mn"), ("DB_PASS=q7Wn3Kx0PbVt5Rm2Lz", "q7Wn3Kx0PbVt5Rm2Lz"),
    ("GET /x?user=1&signature=Zk39fQpLx7%2FRtVb02Mn&y=2", "Zk39fQpLx7%2FRtVb02Mn"), ("api_key2=Zk39fQpLx7RtVb02Mn", "Zk39fQpLx7RtVb02Mn"),
    ("credential: QmZkPxLrTvWnYsBdHgJk", "QmZkPxLrTvWnYsBdHgJk"), ('private_key: "ab$Zk39fQpLx7!2RtVb"', "ab$Zk39fQpLx7!2RtVb"),
    ("{'private_key':'ab(Zk39fQpLx7;2RtVb'}", "ab(Zk39fQpLx7;2RtVb"), ("PASSPHRASE=ab$Zk39fQpLx7!2RtVb!", "ab$Zk39fQpLx7!2RtVb"),
    ("session Zk39fQpLx7Rt end", "Zk39fQpLx7Rt"), ("key-Zk39fQpLx7RtVb02Mn", "Zk39fQpLx7RtVb02Mn"), ("token_4f9Qz1LmVb71Qwe9RtyUi5", "4f9Qz1LmVb71Qwe9RtyUi5"),
    ("bearer sid=Zk39fQpLx7RtVb02Mn==", "Zk39fQpLx7RtVb02Mn==")]


@pytest.mark.parametrize("text, value", FOUND)
def test_values_are_found(text, value):
    novel = [s for s in secrets.scan("Some text before.\n" + text + "\nand after it.", secrets.Novelty(b"")) if s["kind"] == "novel"]
    assert [("Some text before.\n" + text)[s["start"]:s["end"]] for s in novel] == [value]


@pytest.mark.parametrize("text", [
    "authority keyboard monkeys", "keyboardlayoutconfiguration", "The authentication of administrators requires that passwords and other authorization documents are transmitted by responsible organisations. "
    "The key considerations for international collaboration are straightforward communication and characterisation. Each session "
    "begins with announcements about infrastructure.",
    "password=short", "it's a key, isn't it", "secret_access_key_handler", "key" * 20_000, "session=" + "1" * 40])
def test_words_are_not(text):
    assert not [s for s in secrets.scan(text, secrets.Novelty(b"")) if s["kind"] == "novel"]
