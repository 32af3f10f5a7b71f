"""Column expressions: every function here returns a ``Column`` (or a DataFrame
rewrite that only adds/renames columns) and never shuffles."""

from lexgrid.functions.clean import (NA_TOKENS, blank_column, ensure_column, fill_missing,
                                     null_tokens, project, rename, require_columns)
from lexgrid.functions.entity import normalise_name, trust_tier
from lexgrid.functions.labels import (argmax, argmax_positions, cross_entropy, decode_label,
                                      encode_label, extract_response, sequence_correct,
                                      shift_and_mask)
from lexgrid.functions.prompts import (append_answer, apply_chat_template, message_turns,
                                       prefix_prompt, render_template, strip_literal,
                                       to_messages, trim_block)
from lexgrid.functions.sequences import (IGNORE, attention_mask, mask_assistant_spans,
                                         mask_by_boundary, mask_by_marker, pad_to, truncate)

__all__ = [
    "NA_TOKENS", "IGNORE", "append_answer", "apply_chat_template", "argmax", "argmax_positions",
    "attention_mask", "blank_column", "cross_entropy", "decode_label", "encode_label",
    "ensure_column", "extract_response", "fill_missing", "mask_assistant_spans",
    "mask_by_boundary", "mask_by_marker", "message_turns", "normalise_name", "null_tokens", "pad_to",
    "prefix_prompt", "project", "rename", "render_template", "require_columns",
    "sequence_correct", "shift_and_mask", "strip_literal", "to_messages", "trim_block",
    "truncate", "trust_tier",
]
