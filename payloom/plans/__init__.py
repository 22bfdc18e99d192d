"""Logical plans that turn raw documents and employee records into the star schema."""
