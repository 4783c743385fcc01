from layerkit.functions.dates import has_date, safe_date, year_text
from layerkit.functions.messages import from_message, to_message

__all__ = ["has_date", "safe_date", "year_text", "from_message", "to_message"]
