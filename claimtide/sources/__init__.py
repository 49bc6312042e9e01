from claimtide.sources.contract import Contract, Field, apply_contract  # noqa: F401
from claimtide.sources.dictionary import apply_dictionary  # noqa: F401
from claimtide.sources.loaders import (  # noqa: F401
    load_appeal, load_case, load_complete_appeal, load_order_line, load_prior_auth, load_revenue)
from claimtide.sources.readers import (  # noqa: F401
    Delimited, jdbc_options, load_snapshot, order_case_extract, read_delimited, read_jdbc, read_reference, read_since,
    snapshot_versions, split_delimited)
from claimtide.sources.writers import (  # noqa: F401
    Control, ROWS_PER_FILE, log_controls, refresh_log, write_delimited, write_ordered, write_table)
