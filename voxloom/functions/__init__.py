from .numbers import is_number, py_round, safe_int, unit_hash
from .paths import (
    base_name,
    bracket_id,
    encode_segment,
    decode_segment,
    has_extension,
    local_path,
    name_parts_ne,
    natural_key,
    route_paths,
    swap_ext,
)
from .script import convert_text, is_script
from .text import (
    cut_at,
    has_any_char,
    loan_tokens,
    nfkc,
    normalize_basic,
    sentences,
    space_scripts,
    strip_punct,
    strip_tags,
    tokenize_mixed,
)
