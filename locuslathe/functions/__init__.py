"""functions of locuslathe."""
