"""DataFrame-to-DataFrame jobs: build, analyse, maintain, search, hydrate."""
