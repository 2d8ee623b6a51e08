"""sources of locuslathe."""
