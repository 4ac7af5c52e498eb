"""Tables kept up to date while files arrive."""
