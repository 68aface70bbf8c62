"""Chat formatting by prefix-target expansion: every assistant turn becomes one example.

An example is the rendering of all turns before a reply, then the reply; only the reply's text is under the loss mask.
Turns of other roles are `<s>[INST] role\\ntext [/INST]`, replies are `text</s>`. A control string inside a role or text gets
one backslash after its first character (`<\\/s>`), and one that already has backslashes there gets one more, so escaping
is undone by taking one away and no other text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: First characters and remainders of the control strings <s> </s> [INST] [/INST].
_FIRST, _REST = r"[<\[]", r"(?:/?s>|/?INST\])"
OPEN, CLOSE, END = "<s>[INST] ", " [/INST]", "</s>"


def escape(text):
    return F.regexp_replace(text, rf"({_FIRST})(\\*{_REST})", r"$1\\$2")


def unescape(text):
    return F.regexp_replace(text, rf"({_FIRST})\\(\\*{_REST})", "$1$2")


def _escape_role(role):
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role):
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def chat_examples(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Examples: conv, example_no, target_turn, n_turns (in the example), formatted, loss_start, loss_chars (code points).

    Turns that follow the last reply make one more example without a target (target_turn null, loss_chars 0), so no turn is lost.
    Defined cases: null texts and roles count as empty; turns are ordered by number, then role, then text, null numbers
    first; repeated rows are turns of their own; rows with a null conversation id form one conversation; an empty table gives
    no example. The turns of one conversation meet in one row, and the examples of a conversation of n turns hold O(n) prefixes.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = df.select(
        F.col(conv_col).alias("_x_conv"),
        F.struct(
            F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        ).alias("_x_turn"),
    )
    own = turns.groupBy("_x_conv").agg(F.sort_array(F.collect_list("_x_turn")).alias("_x_raw"))
    rendered = own.select(
        "_x_conv",
        F.transform(
            "_x_raw",
            lambda t: F.struct(
                t["turn"].alias("turn"),
                (t["role"] == "assistant").alias("reply"),
                F.when(t["role"] == "assistant", F.concat(escape(t["text"]), F.lit(END)))
                .otherwise(F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE)))
                .alias("out"),
            ),
        ).alias("_x_turns"),
    )
    last = F.col("_x_pos") == F.size("_x_turns") - 1
    context = F.array_join(F.transform(F.slice("_x_turns", 1, F.col("_x_pos")), lambda t: t["out"]), "")
    return (
        rendered.select("_x_conv", "_x_turns", F.posexplode("_x_turns").alias("_x_pos", "_x_target"))
        .filter(F.col("_x_target.reply") | last)
        .select("_x_conv", "_x_pos", "_x_target", context.alias("_x_context"))
        .select(
            F.col("_x_conv").alias(conv_col),
            F.col("_x_pos").alias("example_no"),
            F.when(F.col("_x_target.reply"), F.col("_x_target.turn")).alias("target_turn"),
            (F.col("_x_pos") + 1).alias("n_turns"),
            F.concat("_x_context", "_x_target.out").alias("formatted"),
            F.char_length("_x_context").cast("bigint").alias("loss_start"),
            F.when(F.col("_x_target.reply"), F.char_length("_x_target.out") - len(END)).otherwise(0).cast("bigint").alias("loss_chars"),
        )
    )


def read_turns(formatted):
    """The turns of a formatted example: array of (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, r"(?<= \[/INST\])|(?<=</s>)"), lambda p: p != "")
    def turn(p):
        opened = p.startswith(OPEN)
        body = F.substr(p, F.lit(len(OPEN) + 1), F.char_length(p) - len(OPEN) - len(CLOSE))
        return F.when(
            opened,
            F.struct(
                _unescape_role(F.substring_index(body, "\n", 1)).alias("role"),
                unescape(F.substr(body, F.char_length(F.substring_index(body, "\n", 1)) + 2)).alias("text"),
            ),
        ).otherwise(F.struct(F.lit("assistant").alias("role"), unescape(F.substr(p, F.lit(1), F.char_length(p) - len(END))).alias("text")))
    return F.transform(pieces, turn)


def loss_text(formatted, loss_start, loss_chars):
    """The text under the loss mask, unescaped."""
    return unescape(F.substr(formatted, (loss_start + 1).cast("int"), loss_chars.cast("int")))


def chat_digest(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its examples: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of the full rendering)."""
    slim = examples.select(
        F.col(conv_col).alias("_x_conv"), "example_no", "formatted",
        F.when(F.col("loss_chars") > 0, loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))).otherwise("").alias("_x_loss"),
    )
    per = slim.groupBy("_x_conv").agg(
        F.max(F.struct("example_no", "formatted")).alias("_x_full"),
        F.sort_array(F.collect_list(F.struct("example_no", "_x_loss"))).alias("_x_losses"),
    )
    turns = F.transform(read_turns(F.col("_x_full.formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("_x_losses", lambda x: x["_x_loss"]), "")
    return per.select("_x_conv", turns.alias("_x_t"), loss.alias("_x_l"), F.col("_x_full.formatted").alias("_x_f")).select(
        F.col("_x_conv").alias(conv_col),
        F.size("_x_t").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("_x_t", "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("_x_l").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_x_l").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("_x_f").cast("bigint").alias("formatted_chars"),
    )
