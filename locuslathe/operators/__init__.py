"""operators of locuslathe."""
