"""The source catalog as a stream against a fixed target catalog."""
