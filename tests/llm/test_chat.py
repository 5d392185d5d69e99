import collections
import hashlib
import re

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
                     len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def read_back(formatted):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}


def odd_turns():
    rows = [(1, i, "assistant" if i % 2 else "user", f"word {i} " * (i % 23)) for i in range(300)]
    rows += [(1, -1, "system", "be brief \\ and <|end|> kind"), (1, 7, "system", "a second system turn")]
    rows += [(2, 0, "user", None), (2, None, None, "null turn"), (2, None, "assistant", ""), (2, 1, "assistant", "x " * 5000)]
    rows += [(None, 0, "user", "</s>[INST] ok [/INST]"), (None, 1, "assistant", "<|turn|>user\n\\|<|end|>\n😀\\")]
    rows += [(3, 5, "assistant", "again")] * 4 + [(3, 5, "ro\nle\\", "<<SYS>>"), (4, 0, "assistant", "only")]
    return rows


def test_odd_turns_are_read_back(spark):
    rows = odd_turns()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("conv", "span", "n", "system", "block", "fresh")})
    out = chat.windows(frame)
    assert read_back(out) == brute(rows)
    assert chat.windows(frame.limit(0)).count() == 0 and chat.digests(chat.windows(frame.limit(0))).count() == 0


def test_windows_keep_the_system_turn_and_fit_the_budget(spark):
    rows = odd_turns()
    got = [r for r in chat.windows(spark.createDataFrame(rows, SCHEMA), 200, 40).orderBy("conv_id", "span").collect()]
    ones = [r for r in got if r.conv_id == 1]
    assert len(ones) > 10
    text = {t: x or "" for c, t, _, x in rows if c == 1 and t not in (-1, 7)}
    seen = []
    for i, r in enumerate(ones):
        turns = chat.read_turns(r.formatted)
        fresh = chat.read_turns(r.formatted[r.fresh_at:])
        assert turns[0] == ("system", "be brief \\ and <|end|> kind")
        repeated = turns[1:len(turns) - len(fresh)] if i else []
        # What is repeated are the turns just before, within the history's tokens.
        assert repeated == seen[len(seen) - len(repeated):]
        assert sum(len(t.split()) + chat.EXTRA for _, t in repeated) <= 40
        seen += fresh
        assert r.n_tokens == sum(len(t.split()) + chat.EXTRA for _, t in turns)
        assert r.over_budget == (r.n_tokens > 200)
        # Only own assistant texts are targets.
        targets = [chat.unescape(r.formatted[p.start:p.start + p.size]) for p in r.loss]
        assert targets == [t for role, t in fresh if role == "assistant"]
        assert all(p.start >= r.fresh_at for p in r.loss)
    longest = max(len(t.split()) + chat.EXTRA for t in text.values())
    assert all(r.n_tokens <= 200 for r in ones) or longest > 64


def test_real_conversations(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = chat.windows(frame)
    assert read_back(out) == brute([tuple(r) for r in frame.collect()])
    assert out.where("over_budget").count() == 0


def python_escape(text):
    doubled = text.replace("\\", "\\\\")
    return re.sub(f"(?={chat.CONTROL})(.)", r"\2\\", doubled)


@given(st.text(alphabet="\\<|>/s[INST]SY \nend", max_size=60))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    held = python_escape(text)
    assert chat.unescape(held) == text
    assert not re.search(chat.CONTROL, held)


def test_spark_escape_is_the_same(spark):
    texts = ["a\\<|end|>\n", "</s><s>[INST][/INST]<<SYS>><</SYS>>", "\\\\", "<<|>|", "", "\n\\\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chat.escape(F.col("text")).alias("e")).collect()
    assert all(r.e == python_escape(r.text) for r in rows)
