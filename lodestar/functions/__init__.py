from lodestar.functions.text import (  # noqa: F401
    default_stop_words,
    drop_stop_words,
    letter_tokens,
    lower_all,
    normalise_apostrophe,
    primary_title,
    tag_tokens,
    word_tokens_2plus,
)
