"""Column functions: hashing, URLs, text, versions and markup."""
