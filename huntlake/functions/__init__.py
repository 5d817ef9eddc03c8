from huntlake.functions.entropy import shannon_entropy
from huntlake.functions.names import aliased, column_lookup, field, quoted, text_literal
from huntlake.functions.once import once

__all__ = ["aliased", "column_lookup", "field", "once", "quoted", "shannon_entropy", "text_literal"]
