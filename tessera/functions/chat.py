"""Chat markup as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed_values import ASSISTANT_OPENER, JUDGE_TEMPLATE, TURN_TEMPLATE
from tessera.functions.text import fill


def format_turn(role: Column, content: Column) -> Column:
    return fill(TURN_TEMPLATE, role=role, content=content)


def format_prompt(content: Column) -> Column:
    """One user turn followed by an opened assistant turn."""
    return F.concat(format_turn(F.lit("user"), content), F.lit(ASSISTANT_OPENER))


def format_turns(messages: Column) -> Column:
    """All turns of a message array, without the opener."""
    return F.array_join(F.transform(messages, lambda m: format_turn(m["role"], m["content"])), "")


def format_history(messages: Column) -> Column:
    """All turns of a message array followed by an opened assistant turn."""
    return F.concat(format_turns(messages), F.lit(ASSISTANT_OPENER))


def build_prompt(prompt: Column, chat: Column | bool) -> Column:
    flag = F.lit(chat) if isinstance(chat, bool) else chat
    return F.when(flag, format_prompt(prompt)).otherwise(prompt)


def judge_request(prompt: Column, response_a: Column, response_b: Column) -> Column:
    """The judge template with its three slots filled."""
    return fill(JUDGE_TEMPLATE, prompt=prompt, response_a=response_a, response_b=response_b)
