"""plans of locuslathe."""
