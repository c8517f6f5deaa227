"""Column expressions: text, report formats, pre-tokens and token ids."""
