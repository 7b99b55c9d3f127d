from mcqflow.functions.text import (  # noqa: F401
    py_strip, norm, is_valid_option, total_length, label_letter, letter_label,
    options_block, options_inline,
)
