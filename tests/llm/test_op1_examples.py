"""op1 reads its replies where each example's context ends."""

import hashlib

from pyspark.sql import functions as F

from stratus.llm import chat


def test_wrong_context_shows(spark):
    rows = [(1, 0, "user", "q</turn>"), (1, 1, "assistant", "first"), (1, 2, "user", "q"), (1, 3, "assistant", "a\\b"),
            (2, 0, "user", "only"), (None, 0, "assistant", "n")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    examples = {(r.conv_id, r.turn_no): r.target for r in chat.prefix_target_examples(formatted).collect()}
    assert examples == {(1, 1): "first</turn>", (1, 3): "a\\\\b</turn>", (None, 0): "n</turn>"}
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert back[1].loss_sha256 == hashlib.sha256(b"firsta\\b").hexdigest() and back[2].loss_chars == 0 and back[None].loss_chars == 1
    shifted = formatted.withColumn("examples", F.transform("examples", lambda e: F.struct(
        e.turn_no.alias("turn_no"), (e.context_chars + 1).alias("context_chars"), (e.loss_end + 1).alias("loss_end"))))
    wrong = {r.conv_id: r for r in chat.read_back(shifted).collect()}
    assert wrong[1].loss_sha256 != back[1].loss_sha256 and wrong[1].turns_sha256 == back[1].turns_sha256
