"""Driver-side descriptions: what is mapped and what is asked. No data passes through here."""
