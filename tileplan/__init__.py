"""Planning of satellite-image production as Spark jobs over a catalogue of inputs, validations and tasks."""

from tileplan.catalogue import Catalogue

__all__ = ["Catalogue"]
