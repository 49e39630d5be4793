"""All role rules in order, as literal cases: nothing here is taken from the
library's own table."""

from docsmith.operators import hierarchy as HY

ALGO = "vtkAlgorithm"
# (class, its ancestors, instantiable, has_isa, n_in, n_out, in the catalog, role)
CASES = [
    ("vtkNamedColors", [], False, False, 0, 0, True, "color"),
    ("vtkColorSeries", [], True, True, 0, 0, False, "color"),
    ("vtkMissing", [ALGO], True, True, 0, 1, False, "utility"),
    ("vtkImageAlgorithm", [ALGO], False, True, 1, 1, True, "filter"),
    ("vtkReaderAlgorithm", [], False, False, 0, 1, True, "filter"),
    ("vtkAbstractThing", [ALGO], False, True, 0, 1, True, "utility"),
    ("vtkNoIsA", ["vtkProp"], True, False, 0, 0, True, "utility"),
    ("vtkMultiTimeStepAlgorithm", [ALGO], True, True, 0, 1, True, "filter"),
    ("vtkMapperA", [ALGO, "vtkAbstractMapper"], True, True, 0, 1, True, "properties"),
    ("vtkTextureA", [ALGO, "vtkTexture"], True, True, 0, 1, True, "properties"),
    ("vtkWriterA", [ALGO, "vtkWriter"], True, True, 0, 1, True, "output"),
    ("vtkImageWriterA", [ALGO, "vtkImageWriter"], True, True, 1, 1, True, "output"),
    ("vtkReaderA", [ALGO, "vtkReader"], True, True, 1, 1, True, "input"),
    ("vtkSourceA", [ALGO], True, True, 0, 2, True, "input"),
    ("vtkFilterA", [ALGO], True, True, 1, 1, True, "filter"),
    ("vtkSinkA", [ALGO], True, True, 1, 0, True, "output"),
    ("vtkPortless", [ALGO, "vtkProp"], True, True, 0, 0, True, "filter"),
    ("vtkImporterA", ["vtkImporter"], True, True, 0, 0, True, "input"),
    ("vtkRendererA", ["vtkRenderer"], True, True, 0, 0, True, "renderer"),
    ("vtkWindowA", ["vtkRenderWindow"], True, True, 0, 0, True, "infrastructure"),
    ("vtkStyleA", ["vtkInteractorStyle"], True, True, 0, 0, True, "infrastructure"),
    ("vtkPickerA", ["vtkAbstractPicker"], True, True, 0, 0, True, "infrastructure"),
    ("vtkViewTheme", [], True, True, 0, 0, True, "infrastructure"),
    ("vtkContextA", ["vtkContextItem"], True, True, 0, 0, True, "infrastructure"),
    ("vtkViewA", ["vtkView"], True, True, 0, 0, True, "infrastructure"),
    ("vtkPassA", ["vtkRenderPass"], True, True, 0, 0, True, "renderer"),
    ("vtkExporterA", ["vtkExporter"], True, True, 0, 0, True, "output"),
    ("vtkCameraA", ["vtkCamera"], True, True, 0, 0, True, "scene"),
    ("vtkLightA", ["vtkLightKit"], True, True, 0, 0, True, "scene"),
    ("vtkWidgetA", ["vtk3DWidget"], True, True, 0, 0, True, "scene"),
    ("vtkActorA", ["vtkProp"], True, True, 0, 0, True, "properties"),
    ("vtkPropertyA", ["vtkVolumeProperty"], True, True, 0, 0, True, "properties"),
    ("vtkPlainTexture", ["vtkTexture"], True, True, 0, 0, True, "properties"),
    ("vtkLookupTableB", [], True, True, 0, 0, True, "properties"),
    ("vtkColorTransferFunctionB", [], True, True, 0, 0, True, "properties"),
    ("vtkOpenGLThing", [], True, True, 0, 0, True, "renderer"),
    ("vtkAnything", [], True, True, 0, 0, True, "utility"),
    # an earlier rule wins over a later one
    ("vtkBothA", ["vtkCamera", "vtkProp"], True, True, 0, 0, True, "scene"),
    ("vtkOpenGLCameraA", ["vtkCamera"], True, True, 0, 0, True, "scene"),
    ("vtkWriterReader", [ALGO, "vtkWriter", "vtkReader"], True, True, 0, 0, True, "output"),
]


def test_every_rule(spark):
    classes = spark.createDataFrame([(n, i, h, a, b) for n, _, i, h, a, b, known, _ in CASES if known], "class_name string, instantiable boolean, has_isa boolean, n_in long, n_out long")
    names = spark.createDataFrame([(c[0],) for c in CASES], "class_name string")
    bases = spark.createDataFrame([(c[0], a) for c in CASES for a in c[1]], "class_name string, base_name string")
    got = {r.class_name: r.role for r in HY.roles(names, classes, HY.isa_flags(bases)).collect()}
    assert got == {c[0]: c[-1] for c in CASES}
