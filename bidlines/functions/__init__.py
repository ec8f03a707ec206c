from .calls import error_class
from .names import base_name, file_stem, has_relevant_extension, is_blocked_name, is_relevant_attachment
from .text import (
    clean_cell,
    clean_description,
    clean_unit,
    collapse,
    drop_lines,
    drop_repeated_title,
    first_group,
    keep_label_value,
    percentage,
    strip,
    text_similarity,
)
