"""Column expressions. All are built-in Spark functions, so they stay in whole-stage codegen."""

from scholarspark.functions.dates import complete_date_text, parse_date, days_between, month_label  # noqa: F401
from scholarspark.functions.citations import cit_total, cit_first_year, cit_two_years_or_more  # noqa: F401
from scholarspark.functions.text import (code_point_length, author_count, merged_text,  # noqa: F401
                                         search_normalise, padded, tokens, clean_text,
                                         whitespace_tokens, normalised_tokens, sentence_split)
from scholarspark.functions.recode import (category_group, publication_status, binary_status,  # noqa: F401
                                           publication_label, ln_or_null, STATUS_ORDER)
